"""Print the static physical plan shape of registered reports as it would be at scale.

Usage: python tools/plan_shape.py <tables_root> [name,name,...] [--tree]

``tables_root`` holds the report tables as parquet directories (e.g. written by
``ledgerline.sources.fixtures.write_fixture_tables``). Automatic broadcast is disabled
and AQE is off, so every join shows the shuffle it needs on large inputs.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    from ledgerline.registry import run, specs
    from ledgerline.session import build_session
    from ledgerline.sources.catalog import Catalog

    root = argv[1]
    names = argv[2].split(",") if len(argv) > 2 and not argv[2].startswith("--") else list(specs())
    spark = build_session("local[4]", 4, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                                 "spark.sql.adaptive.enabled": "false"})
    cat = Catalog.from_parquet(spark, root)
    for name in names:
        df = run(name, cat)
        tree = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n\n")[0]
        shuffles = tree.count("Exchange") - tree.count("BroadcastExchange")
        print(f"{name}: shuffles={shuffles} broadcasts={tree.count('BroadcastExchange')} "
              f"sort_merge_joins={tree.count('SortMergeJoin')} broadcast_joins={tree.count('BroadcastHashJoin')}")
        if "--tree" in argv:
            print(tree)


if __name__ == "__main__":
    main(sys.argv)
