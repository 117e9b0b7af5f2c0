"""Command line: ``python -m lodestrata {ingest,search,check} --root STORE ...``"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from lodestrata.corpus import Corpus


def main(words: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestrata")
    parser.add_argument("--root", required=True, help="folder of the store, shared by all executors")
    commands = parser.add_subparsers(dest="command", required=True)
    take = commands.add_parser("ingest")
    take.add_argument("folder")
    take.add_argument("collection", nargs="?", default="default")
    find = commands.add_parser("search")
    find.add_argument("query")
    find.add_argument("--mode", choices=("vector", "graph", "map"), default="vector")
    find.add_argument("--hops", type=int, default=2)
    find.add_argument("--n", type=int, default=5)
    find.add_argument("--collection", default="default")
    commands.add_parser("check").add_argument("folder")
    given = parser.parse_args(words)
    corpus = Corpus(SparkSession.builder.appName("lodestrata").getOrCreate(), given.root)
    if given.command == "ingest":
        print(", ".join(f"{k}: {n}" for k, n in sorted(corpus.ingest(given.folder, given.collection).items())) or "no files")
    elif given.command == "check":
        report, orphans, ok = corpus.check(given.folder)
        report.orderBy("source").show(1000, False)
        orphans.orderBy("source").show(1000, False)
        return 0 if ok else 1
    elif given.mode == "map":
        for concept, near in corpus.concept_map(given.query, given.hops).items():
            print(f"{concept}: {', '.join(near)}")
    else:
        if given.mode == "graph":
            print("expanded by:", ", ".join(corpus.expand(given.query, given.hops)[:5]))
        found = corpus.search_graph(given.query, given.n, given.hops, given.collection) if given.mode == "graph" else corpus.search(given.query, given.n, given.collection)
        for i, text in enumerate(found, 1):
            print(f"[{i}] {text}\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())
