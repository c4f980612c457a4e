import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from attrition.session import local_session

    s = local_session("*", shuffle_partitions=8, app="attrition-tests", driver_memory="4g")
    yield s
    s.stop()


def literal_onehot(df, vocab, key="id_ga"):
    """Reference one-hot: explode each set column on its own, max per dummy, join on the key."""
    from functools import reduce

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from attrition.operators import features as FT

    parts = []
    for c in dict.fromkeys(c for c, _ in vocab):
        values = [v for cc, v in vocab if cc == c]
        col = F.explode_outer(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c)
        rows = df.select(key, col.alias("x"))
        parts.append(rows.groupBy(key).agg(*[F.max(F.coalesce(F.col("x") == v, F.lit(False)))
                                            .alias(FT.dummy_name(c, v)) for v in values]))
    return reduce(lambda a, b: a.join(b, key), parts)
