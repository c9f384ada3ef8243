"""Split a dataset's documents into train, validation and test, with no author in two of them. Inputs stay where they are."""

from __future__ import annotations

import argparse

from korpuswerk.cli import session
from korpuswerk.operators import split
from korpuswerk.sources import readers, writers


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input-dir", required=True)
    for name in split.SPLITS:
        p.add_argument(f"--output-dir-{name}")
    p.add_argument("--year-start", type=int)
    p.add_argument("--year-end", type=int)
    p.add_argument("--size-test", type=float, default=0.1)
    p.add_argument("--dry-run", action="store_true", help="print the documents of each split instead")
    return p.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = parse(args)
    spark = session("split_dataset")
    docs = split.documents(readers.first_records(spark, a.input_dir), a.year_start, a.year_end)
    parts = split.split(docs, a.size_test)
    if a.dry_run:
        for r in parts.orderBy("split", "basename").toLocalIterator():
            print(r.split, r.basename, r.decade, r.genre)
        return
    outs = {name: getattr(a, f"output_dir_{name}") for name in split.SPLITS}
    if None in outs.values():
        raise SystemExit("an output directory is needed for each split")
    writers.write_splits(readers.drop_absent(readers.read_dataset(spark, a.input_dir, recursive=False)), parts, outs)


if __name__ == "__main__":
    main()
