"""A small shell: python -m sparkloom.client.shell [-c SQL] [FOLDER], with the tables of a folder as views."""

from __future__ import annotations

import argparse
import sys

from sparkloom.session import register, session

from .engine import Engine, split_statements


def answer(engine: Engine, text: str) -> str:
    """What a line gives: .tables, .schema NAME, or a script's last result as text."""
    word, _, rest = text.strip().partition(" ")
    if word == ".tables":
        return "\n".join(sorted(r["name"] for r in engine.tables().collect()))
    if word == ".schema":
        return "\n".join(f"{c.name} {c.type}" for c in engine.table_columns(rest.strip()))
    if not split_statements(text):
        return ""
    return engine.sql(text).limit(100).toPandas().to_string(index=False)  # a screenful


def main(argv: list[str]) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("-c", dest="command")
    p.add_argument("folder", nargs="?")
    a = p.parse_args(argv)
    spark = session()
    if a.folder:
        register(spark, a.folder)
    engine = Engine(spark)
    for text in [a.command] if a.command else iter(lambda: input("> "), ".quit"):
        print(answer(engine, text))


if __name__ == "__main__":
    main(sys.argv[1:])
