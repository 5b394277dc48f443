"""python -m distriq list | run NAME DIRECTORY [OUT] | explain NAME DIRECTORY | export DIRECTORY OUT"""

from __future__ import annotations

import sys

from distriq.plans import parsing, preparation, relational
from distriq.session import local_session, ship
from distriq.sources.files import export_csv
from distriq.sources.tables import load


def _session():
    spark = local_session()
    ship(spark)
    return spark


def main(args: list[str]) -> int:
    queries = preparation.QUERIES | relational.QUERIES | parsing.QUERIES
    if args[:1] == ["list"]:
        print("\n".join(queries))
    elif args[:1] == ["run"] and len(args) in (3, 4) and args[1] in queries:
        df = queries[args[1]](_session(), args[2])
        df.write.mode("overwrite").parquet(args[3]) if len(args) == 4 else df.show(50, truncate=False)
    elif args[:1] == ["explain"] and len(args) == 3 and args[1] in queries:
        queries[args[1]](_session(), args[2]).explain("formatted")
    elif args[:1] == ["export"] and len(args) == 3:
        spark = local_session()
        export_csv({t: load(spark, args[1], t) for t in relational.TABLES}, args[2])
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
