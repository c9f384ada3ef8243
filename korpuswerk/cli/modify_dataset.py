"""Apply a modifier to a dataset. All files are one dataset, so --merge-into-single-dataset changes nothing but is accepted."""

from __future__ import annotations

import argparse

from korpuswerk import registry
from korpuswerk.cli import session
from korpuswerk.sources import mappings, readers, writers


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("-m", "--modifier", required=True, help=f"one of {', '.join(registry.MODIFIERS)}")
    p.add_argument("--modifier-kwargs", nargs="*", default=[], help="name=value pairs, separated by white space")
    p.add_argument("--data", required=True, help="file or directory, searched for *.jsonl")
    p.add_argument("-o", "--output", required=True, help="directory, or file with --output-single-file")
    p.add_argument("--output-single-file", action="store_true")
    p.add_argument("--merge-into-single-dataset", action="store_true")
    return p.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = parse(args)
    spark = session("modify_dataset")
    records = readers.drop_absent(readers.read_dataset(spark, a.data))
    modified = records.transform(registry.modifier(spark, a.modifier, **mappings.options(a.modifier_kwargs)))
    (writers.write_single if a.output_single_file else writers.write_grouped)(modified, a.output)


if __name__ == "__main__":
    main()
