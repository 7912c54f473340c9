"""The report feed from wherever it can be had."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from trustline.functions.casts import lowercase_columns
from trustline.operators.rollup import daily_status_rollup
from trustline.sources.schemas import FEED
from trustline.sources.tables import materialise, read_snapshot, scratch_folder
from trustline.sources.versions import Versions

log = logging.getLogger(__name__)


def live_feed(spark: SparkSession, mart: str) -> DataFrame:
    """The rollup of the stored mart, named as a table or as a Parquet path.

    A build stores the rollup with its mart, and that of the last version is read where there are versions.
    """
    versions = Versions(mart)
    if "/" in mart and versions.numbers(spark):
        return versions.read(spark, versions.manifest(spark), "feed", FEED)
    stored = spark.read.parquet(mart) if "/" in mart else spark.table(mart)
    feed = daily_status_rollup(stored)
    feed.schema  # analysed now, so that a mart that is missing or unfit shows here
    return feed


def load_feed(spark: SparkSession, mart: str | None, snapshot: str) -> DataFrame:
    """The live feed, or the snapshot when there is no usable mart; empty when neither exists.

    The rollup is run and stored here, so that a mart that can't be read shows here, too, and
    readers of the feed don't repeat it.
    """
    if mart is None:
        return lowercase_columns(read_snapshot(spark, snapshot))
    try:
        feed = materialise(live_feed(spark, mart), f"{scratch_folder(spark, 'feed')}/feed")
        log.info("feed from the mart %s", mart)
        return lowercase_columns(feed)
    except (PySparkException, Py4JJavaError) as error:
        log.warning("feed from the snapshot %s: %s", snapshot, str(error).split("\n")[0])
        return lowercase_columns(read_snapshot(spark, snapshot))
