"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---------------------------------------------------------------- quality
def counts(text):
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    covered = set()
    for i, w in enumerate(zip(ws, ws[1:], ws[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def base_failed(c):
    return c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]


def binomial_tail(n, k, p):
    p = Fraction(p).limit_denominator(10 ** 9)
    return float(sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1)))


RULES = {"symbols": lambda c: c["n_symbols"] / c["word_chars"] if c["word_chars"] else None,
         "repeats": lambda c: c["n_repeat_words"] / c["n_words"] if c["n_words"] else None,
         "lines": lambda c: c["n_dup_lines"] / c["n_lines"] if c["n_lines"] else None,
         "long_words": lambda c: min(c["word_chars"] / c["n_words"] / 20, 1) if c["n_words"] else None}


def quality(docs, labels, grids, risk=0.04, delta=0.05):
    """doc rows (doc_id, text, stratum) and labels (doc_id, quality) -> {doc_id: kept}."""
    by_doc = defaultdict(list)
    for doc_id, q in labels:
        if q is not None:
            by_doc[doc_id].append(q)
    good = {d: min(qs) == 1 for d, qs in by_doc.items()}
    cs = [(d, s, counts(t)) for d, t, s in docs]
    reaches = lambda r, c, cutoff: RULES[r](c) is not None and RULES[r](c) >= cutoff

    def in_use(members):
        """The rules that are the best one for a labelled bad document of the strata, and their labelled good documents."""
        mine = [(good[d], c) for d, s, c in cs if s in members and d in good and not base_failed(c)]
        broken = [[r for r in RULES if reaches(r, c, min(grids[r]))] for g, c in mine if not g]
        caught = {r: sum(r in b for b in broken) for r in RULES}
        return [r for r in RULES if any(b and max(b, key=caught.get) == r for b in broken)], [c for g, c in mine if g]

    strata = {s: in_use([s]) for s in {s for _, s, _ in cs}}
    strata = {s: x for s, x in strata.items() if x[1]}
    pool = []
    for s, (used, holdout) in strata.items():
        m = max(1, len(used))
        if (1 - risk / m) ** len(holdout) > delta / (m * len(strata)):
            pool.append(s)
    groups = [([s], *x) for s, x in strata.items() if s not in pool] + ([(pool, *in_use(pool))] if pool else [])
    tests = sum(len(used) for _, used, _ in groups)
    cut = {}
    for members, used, holdout in groups:
        for r in used:
            share = risk / len(used)
            for cutoff in grids[r]:
                k = sum(reaches(r, c, cutoff) for c in holdout)
                if k > len(holdout) * share or binomial_tail(len(holdout), k, share) > delta / tests:
                    break
                cut |= {(s, r): cutoff for s in members}
    out = {}
    for d, s, c in cs:
        broken = [r for r, score in RULES.items() if (s, r) in cut and score(c) is not None and score(c) >= cut[s, r]]
        out[d] = not base_failed(c) and not broken
    return out


# ---------------------------------------------------------------- duplicates
def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text, n):
    ws = ascii_lower(text).encode().split()
    if not ws:
        return frozenset()
    if len(ws) < n:
        return frozenset([tuple(ws)])
    return frozenset(zip(*(ws[i:] for i in range(n))))


def components(docs, n, percent):
    """(doc_id, text) rows -> list of (n_shingles, component_id), compared pair by pair."""
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}  # rows without an id give no name
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


# ---------------------------------------------------------------- secrets
ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
                    r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE = [("assign", ASSIGN, lambda m: len(m[2]) >= 12), ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)]


def entropy(window):
    n = len(window)
    return -sum(c / n * math.log2(c / n) for c in Counter(window).values())


def plain_part(part):
    """Words with vowels, numbers, or very short."""
    if len(part) <= 3 or part.isdigit() and len(part) <= 8:
        return part.isalnum()
    letters = part.strip("0123456789")
    front, back = len(part) - len(part.lstrip("0123456789")), len(part) - len(part.rstrip("0123456789"))
    if not letters.isalpha() or not letters.isascii() or front > 4 or back > 4 or not set(letters) & set("aeiouyAEIOUY"):
        return False
    head = part if part[0].isalpha() else ""  # a run of consonants counts from the start of the letters
    run = 0
    for c in head if head else "":
        if not c.isalpha():
            break
        run = 0 if c in "aeiouyAEIOUY" else run + 1
        if run >= 5:
            return False
    i = 0
    while i < len(letters):  # camel case: [A-Z][a-z]+, [a-z]{2,} or [A-Z]{2,}
        k = i + letters[i].isupper()
        while k < len(letters) and letters[k].islower():
            k += 1
        if k - i < 2:
            k = i
            while k < len(letters) and letters[k].isupper():
                k += 1
            if k - i < 2:
                return False
        i = k
    return True


def longest_odd(value):
    value = re.sub(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])", " ", value)
    best = now = 0
    for part in re.split(r"([^A-Za-z0-9+])", value):
        if part == " " or part and part[0] not in "/_=-" and plain_part(part):
            now = 0
        elif part and part[0] not in "/_=-":
            now += len(part)
            best = max(best, now)
    return best


def secrets(text, classes, allow, odd=12):
    text = text or ""
    base, per_kind = [], []
    for rank, (kind, pattern, keep) in enumerate(BASE):
        spans = [m.span() for m in pattern.finditer(text) if keep(m)]
        per_kind.append(len(spans))
        base += [(s, rank, f"{kind}:{s}:{e}", e) for s, e in spans]
    added = []
    for rank, cls in enumerate(classes, len(BASE)):
        for m in re.finditer(cls.pattern, text):
            s, e = m.span()
            if any(b[0] <= s and e <= b[3] for b in base) or any(re.search(a, m[0]) for a in allow):
                continue
            if longest_odd(m[0]) < odd:
                continue
            if max((entropy(m[0][i:i + cls.window]) for i in range(len(m[0]) - cls.window + 1)), default=0) >= cls.threshold - 1e-9:
                added.append((s, rank, f"{cls.kind}:{s}:{e}", e))
    joined = lambda xs: ",".join(x[2] for x in sorted(xs))
    return (*per_kind, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added))


# ---------------------------------------------------------------- licences
def licences(text, templates, least):
    def grams(t):
        ws = re.sub(r"[^A-Za-z0-9]+", " ", t).lower().split()
        return set(zip(ws, ws[1:]))

    text = text or ""
    units = {" ".join(re.sub(r"[^A-Za-z0-9]+", " ", u).lower().split())
             for u in [*text.split("\n"), *re.split(r"\n[^A-Za-z0-9]*\n", text), text, *re.split(r"[.!?;:]+[ \t-\r]+", text)]}
    n, names, top = 0, set(), 0.0
    for u in units:
        g = grams(u)
        scores = {name: max(2 * len(g & grams(t)) / (len(g) + len(grams(t))) if g else 0.0 for t in ts)
                  for name, ts in templates.items()}
        best = max(scores.values())
        if best >= least:
            n, top = n + 1, max(top, best)
            names |= {k for k, v in scores.items() if v == best}
    return n, ",".join(sorted(names)), top


# ---------------------------------------------------------------- mixing
def targets(sizes, weights, ceiling):
    """By bisection on the common unit, where the operator reshapes step by step."""
    total = sum(sizes)
    if not total:
        return [0.0] * len(sizes)
    low, high = 0.0, float(ceiling * total + 1)
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(unit * w, ceiling * s) for s, w in zip(sizes, weights)) < total:
            low = unit
        else:
            high = unit
    return [min(high * w, ceiling * s) for s, w in zip(sizes, weights)]


# ---------------------------------------------------------------- language model
class SuffixTree:
    """The same tree over dicts: contexts are tuples of symbols, the latest first."""

    def __init__(self, docs, o):
        train = [ascii_lower(t).encode().split() + [None] for d, t in docs if zlib.crc32(str(d).encode()) % 5 != 1]
        self.count = Counter(x for doc in train for x in doc)
        self.n, self.v = sum(self.count.values()), len(self.count)
        often = {w for w, c in self.count.items() if c >= max(2, o.symbol_share * self.n)} | {None}
        self.often = often
        self.root = {w: (self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1)) for w in often}
        self.root["rare"] = 1 - sum(self.root.values())
        coded = [[x if x in often else "rare" for x in doc] for doc in train]
        self.states = {(): None}
        enough = max(o.least_context, o.context_share * self.n)
        least_next = max(o.least_entry, o.next_share * self.n)
        least_entry = max(o.least_entry, o.entry_share * self.n)
        candidates = {(w,) for w in often if self.count[w] >= enough}
        for depth in range(1, o.depth + 1):
            occurs, nexts, whole = Counter(), defaultdict(Counter), Counter()
            for doc in coded:
                for i, x in enumerate(doc):
                    c = self._before(doc, i, depth)
                    if c in candidates:
                        occurs[c] += 1
                        if x != "rare" and self.count[x] >= least_next:
                            nexts[c][x] += 1
                    # sequences of symbols only, which may begin with the end of the document before
                    if x != "rare" and "rare" not in c and "nothing" not in c:
                        whole[(x, *c)] += 1
            new = {}
            for c in candidates:
                kept = {x: n for x, n in nexts[c].items() if n >= least_entry}
                held = sum(kept.values())
                backoff = o.backoff + occurs[c] - held
                gain = share = below = 0.0
                for x, n in kept.items():
                    p = self.p(x, c[:-1])
                    own = (n + backoff * p) / (held + backoff)
                    gain, share, below = gain + n * math.log(own / p), share + own, below + p
                if occurs[c] > held:
                    gain += (occurs[c] - held) * math.log(max(1 - share, 1e-12) / max(1 - below, 1e-12))
                if occurs[c] and gain > 0.5 * len(kept) * math.log(max(occurs[c], 2)):
                    new[c] = (kept, backoff, held + backoff)
            self.states.update(new)
            # every frequent sequence one symbol longer whose suffix (without its first symbol, the last here) was retained
            candidates = {c for c, n in whole.items() if n >= enough and c[:-1] in new}

    @staticmethod
    def _before(doc, i, depth):
        """The ``depth`` symbols before position i, the latest first; the end of a document stands before the first."""
        if i + 1 < depth:
            return ("nothing",) * depth
        return tuple(doc[j] if j >= 0 else None for j in range(i - 1, i - 1 - depth, -1))

    def p(self, x, context):
        p = self.root[x]
        for length in range(1, len(context) + 1):
            state = self.states.get(context[:length])
            if state is None:
                break
            p = (state[0].get(x, 0) + state[1] * p) / state[2]
        return p

    def unigram(self, w):
        return (self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def score(self, text, depth):
        raw = ascii_lower(text).encode().split() + [None]
        doc = [x if x in self.often else "rare" for x in raw]
        base = sum(math.log10(self.unigram(w)) for w in raw)
        total = 0.0
        for i, (x, w) in enumerate(zip(doc, raw)):
            longest = ()
            for length in range(1, depth + 1):
                c = self._before(doc, i, length)
                if c not in self.states:
                    break
                longest = c
            total += math.log10(self.p(x, longest))
            if x == "rare":
                total += math.log10(self.unigram(w) / self.root["rare"])
        return len(raw), sum(self.count[w] > 0 for w in raw), base, total
