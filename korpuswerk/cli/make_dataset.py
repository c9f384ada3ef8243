"""Raw corpus and metadata to a dataset: a JSON lines file for each document."""

from __future__ import annotations

import argparse

from korpuswerk import registry
from korpuswerk.cli import session
from korpuswerk.sources import writers


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("-m", "--maker", required=True, help=f"one of {', '.join(registry.MAKERS)}")
    p.add_argument("--data", required=True, help="file, directory or glob of the raw corpus")
    p.add_argument("--metadata", required=True, help="JSON lines with the documents' metadata")
    p.add_argument("-o", "--output-dir", required=True)
    return p.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = parse(args)
    writers.write_grouped(registry.maker(a.maker)(session("make_dataset"), a.data, a.metadata), a.output_dir)


if __name__ == "__main__":
    main()
