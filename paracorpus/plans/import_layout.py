"""``python -m paracorpus.plans.import_layout --source DIR --target DIR``: layout files of a finished OCR run as page texts."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .stages import import_layout


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--source", required=True)
    args.add_argument("--target", required=True)
    given = args.parse_args(argv)
    print(import_layout(SparkSession.builder.getOrCreate(), given.source, given.target), "pages")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
