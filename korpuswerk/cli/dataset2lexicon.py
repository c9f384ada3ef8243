"""Build an n-gram alignment lexicon from a dataset. A document is a file."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from korpuswerk.cli import session
from korpuswerk.functions import text as X
from korpuswerk.operators import lexicon
from korpuswerk.sources import readers, writers


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--data", required=True, help="file, directory or glob")
    p.add_argument("-o", "--out", required=True)
    p.add_argument("-s", "--ngram_separator", default=X.SEPARATOR)
    p.add_argument("-x", "--transliterate", action="store_true", help="transliterate orig")
    p.add_argument("--keep-none-alignments", action="store_true")
    return p.parse_args(args)


def main(args: list[str] | None = None) -> None:
    a = parse(args)
    records = readers.read_dataset(session("dataset2lexicon"), a.data)
    writers.write_lexicon(lexicon.build(records, F.col("_metadata.file_path"), a.transliterate, a.keep_none_alignments, a.ngram_separator), a.out)


if __name__ == "__main__":
    main()
