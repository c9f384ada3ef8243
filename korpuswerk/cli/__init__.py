"""The four programs: make_dataset, modify_dataset, split_dataset, dataset2lexicon. Run as python -m korpuswerk.cli.NAME."""

from pyspark.sql import SparkSession


def session(name: str) -> SparkSession:
    """The session that the launcher configured, or a local one."""
    return SparkSession.builder.appName(name).getOrCreate()
