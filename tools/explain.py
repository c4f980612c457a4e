"""Print the formatted physical plans of the headline operators (plan review aid).

    python tools/explain.py [sf_dir] > /tmp/plans.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str) -> None:
    from attrition.operators import features as FT
    from attrition.operators import installs as I
    from attrition.operators import joins as J
    from attrition.operators import model as M
    from attrition.plans import registry as RG
    from attrition.session import local_session
    from attrition.sources import tables

    spark = local_session(8, 8)
    p = RG.P
    t = RG.inputs(spark, sf_dir)
    lazy = p.with_(materialise=False)
    installs = I.build_installs(t["attribution_events"], lazy)
    ga_bruto = J.sampled_lean_hits(installs, t["hits"], lazy)
    plans = {
        "device map (SRC2)": tables.visitor_device_map(tables.normalised_hits(t["hits"], p)),
        "install definition table (PIP1)": installs,
        "sampled hits (JN3+JN4)": ga_bruto,
        "session facts (PIP2)": J.session_facts(ga_bruto, tables.customers_with_age_band(t["customers"], p), p),
        "user aggregate (AGG2+AGG3)": FT.user_aggregates(RG.joined_facts(spark, sf_dir), p),
        "correlation moments (ML2)": M.corr_matrix(RG.feature_rows(spark, sf_dir)),
    }
    for name, df in plans.items():
        print(f"\n===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
