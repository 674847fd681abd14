"""Command line: python -m payloom.plans.cli {migrate,ingest,rules,report,pipeline,vacuum} --store FOLDER [--force] [FILE ...], query --store FOLDER --sql STATEMENT, or generate --out FOLDER [--count N] [--seed N]"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from payloom.plans import ingest as runs
from payloom.sources import synthetic
from payloom.sources.store import Store


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="payloom")
    parser.add_argument("verb", choices=("migrate", "ingest", "rules", "report", "pipeline", "vacuum", "query", "generate"))
    parser.add_argument("files", nargs="*")
    parser.add_argument("--store")
    parser.add_argument("--quarantine")
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--count", type=int, default=3000)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--out")
    parser.add_argument("--sql")
    given = parser.parse_intermixed_args(arguments)
    needed = "out" if given.verb == "generate" else "store"
    if getattr(given, needed) is None:
        parser.error(f"{given.verb} needs --{needed}")
    spark = spark or SparkSession.builder.appName("payloom").getOrCreate()
    if given.verb == "generate":
        synthetic.write_csv(synthetic.generate(spark, given.count, given.seed), given.out)
        print("written:", given.out)
        return 0
    store = Store(spark, given.store)
    verbs = ("migrate", "ingest", "rules", "report") if given.verb == "pipeline" else (given.verb,)
    for verb in verbs:
        if verb == "migrate":
            runs.migrate(store)
        elif verb == "ingest":
            for done in runs.ingest(store, given.files, given.force, given.quarantine):
                print("already present:" if done["already_present"] else "ingested:", done)
        elif verb == "vacuum":
            print("folders deleted:", store.vacuum())
        elif verb == "query":
            if given.sql is None:
                parser.error("query needs --sql")
            for row in runs.query(store, given.sql):
                print(json.dumps(row, default=str))
        elif verb == "rules":
            found = runs.run_rules(store)
            print("\n".join(f"  {code:<16}{n:>8}" for code, n in sorted(found.items(), key=lambda x: (-x[1], x[0]))), f"\n  {'total':<16}{sum(found.values()):>8}")
        else:
            print(runs.report(store))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
