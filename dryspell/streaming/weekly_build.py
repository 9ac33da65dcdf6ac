"""The incremental weekly build as a stream of listings, with the state of each file kept between batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dryspell.functions.text import base_name
from dryspell.plans.ingest import ingest
from dryspell.sources.manifests import WEEKLY_MARK

#: A line says that a source lists a URL, or (``kind`` is ``posted``) that a URL is there.
LINE_SCHEMA = "source string, url string, kind string"

#: Of one file: which sources list it under which URLs, which URLs are there, and which sources were handed on.
STATE_SCHEMA = "sources array<string>, urls array<string>, posted array<string>, sent array<string>"
READY_SCHEMA = "file string, source string, url string"


def file_lines(rows: DataFrame) -> DataFrame:
    """Lines that name weekly files, with the file's name."""
    return rows.where(F.col("url").contains(WEEKLY_MARK)).withColumn("file", base_name("url"))


def completed(
    required_sources: Sequence[str] | None, gate_posted: bool
) -> Callable[[tuple[str], Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The step of one file: new lines go into its state, and what became ready comes out.

    A file is ready when every required source lists it and, with ``gate_posted``, every URL not handed on yet is
    there. A source that lists it later comes out alone. The state holds a few strings a source, whatever the
    number of lines: repeated lines change nothing.
    """
    required = set(required_sources or ())

    def step(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sources, urls, posted, sent = state.get if state.exists else ([], [], [], [])
        listed, posted, sent = list(zip(sources, urls)), set(posted), set(sent)
        for batch in batches:
            for source, url, kind in zip(batch["source"], batch["url"], batch["kind"]):
                if kind == "posted":
                    posted.add(url)
                elif (source, url) not in listed:
                    listed.append((source, url))
        waiting = [(source, url) for source, url in listed if source not in sent]
        complete = required <= {source for source, _ in listed}
        if complete and all(url in posted for _, url in waiting if gate_posted):
            yield pd.DataFrame([(key[0], *entry) for entry in waiting], columns=["file", "source", "url"])
            sent |= {source for source, _ in waiting}
        state.update(([s for s, _ in listed], [u for _, u in listed], sorted(posted), sorted(sent)))

    return step


def weekly_build_stream(
    spark: SparkSession,
    lines_dir: str,
    sources: Sequence[str],
    weekly_dir: str,
    state_dir: str,
    checkpoint_dir: str,
    required_sources: Sequence[str] | None = None,
    gate_posted: bool = False,
) -> StreamingQuery:
    """Run the weekly build whenever new ``source,url[,kind]`` CSV files arrive in ``lines_dir``.

    The stream processes what is there and stops; start it again for later arrivals. A week may be completed by
    lines of different batches: what earlier ones said is in the state of its file, so a batch reads its own
    lines only. A batch that is repeated after a failure finds what it built already in the archive.
    """
    lines = file_lines(spark.readStream.schema(LINE_SCHEMA).csv(lines_dir))
    ready = lines.groupBy("file").applyInPandasWithState(
        completed(required_sources, gate_posted), READY_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )

    def build(batch: DataFrame, _: int) -> None:
        ingest(batch.sparkSession, batch, sources, weekly_dir, state_dir)

    return (
        ready.writeStream.foreachBatch(build).outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
