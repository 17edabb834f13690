"""Which listed keys are absent from the index? Batch and deliver those."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions import is_submitted, safe_error
from twinledger.operators import joins, ordering, windows
from twinledger.operators.lists import NARROW_ROWS
from twinledger.session import materialize
from twinledger.sources import append_outcomes, done_keys, read_outcomes
from twinledger.sources.ledger import BATCH_FEED

# Takes the comma-joined keys of one batch; returns (HTTP status, body).
Sender = Callable[[str], tuple[int, str]]

BATCH_SIZE = 500
SUBMIT_STAGE = "SUBMIT"
DONE = ["skipped", "submitted"]

OUTCOMES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

_ANSWERS = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)


def split_listed(keys: DataFrame, docs: DataFrame, max_rows: int = NARROW_ROWS) -> DataFrame:
    """Distinct listed keys with `present`: already in the index or not."""
    return joins.key_presence(keys, docs, max_rows)


def deliver(
    payloads: DataFrame, sender: Sender, concurrency: int = 20, stage: str = SUBMIT_STAGE
) -> DataFrame:
    """Call `sender` once per batch; one outcome row per key.

    At most `concurrency` batches are in flight. A task that is retried sends
    its batches again, so delivery is at least once. A call that raises counts
    as failed for its batch only; `stage` names the step in failed rows.
    """

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = []
            for payload in frame["payload"]:
                try:
                    answers.append(sender(payload))
                except Exception as e:  # noqa: BLE001 - reported as the batch's outcome
                    answers.append((0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(
                {
                    "batch": frame["batch"],
                    "keys": frame["keys"],
                    "status": pd.array([a[0] for a in answers], dtype="Int32"),
                    "body": [a[1] for a in answers],
                }
            )

    answers = (
        payloads.select("batch", "payload", "keys")
        .repartition(concurrency)
        .mapInPandas(send, _ANSWERS)
    )
    ok = is_submitted(F.col("status"), F.col("body"))
    shown = F.concat(F.lit("HTTP "), F.col("status"), F.lit(": "), safe_error(F.col("body")))
    return answers.select(
        F.explode("keys").alias("key"),
        "batch",
        F.when(~ok, F.lit(stage)).alias("stage"),
        F.when(~ok, shown).alias("error"),
        F.when(ok, "submitted").otherwise("failed").alias("outcome"),
    )


def replay(
    keys: DataFrame,
    docs: DataFrame,
    path: str,
    sender: Sender,
    batch_size: int = BATCH_SIZE,
    concurrency: int = 20,
    limit: int | None = None,
    feed: str = BATCH_FEED,
    max_rows: int = NARROW_ROWS,
    wave_batches: int | None = None,
    part_rows: int = windows.PART_ROWS,
) -> DataFrame:
    """Skip keys done before, check the rest against the index, deliver missing.

    Outcomes (`skipped`, `submitted`, `failed`) are appended to the table at
    `path`, which is also the resume ledger: failed keys are tried again next
    time. Skipped keys are recorded first; then about `wave_batches` batches at a
    time (ten for each in flight, if not given) are delivered and recorded, so a
    call that dies loses the record of one such wave and no more. Returns this
    run's outcomes, read back from the table, so using them never sends anything
    twice.
    """
    spark = keys.sparkSession
    earlier = done_keys(read_outcomes(spark, path, OUTCOMES), "key", DONE)
    # Stored, as the check reads it several times.
    pending = materialize(ordering.limit_inputs(keys, earlier, "key", limit), "replay-pending")
    checked = materialize(split_listed(pending, docs, max_rows), "replay-checked")
    nothing = F.lit(None).cast("string")
    skipped = checked.where("present").select(
        "key",
        nothing.alias("batch"),
        nothing.alias("stage"),
        nothing.alias("error"),
        F.lit("skipped").alias("outcome"),
    )
    run = append_outcomes(skipped, path, feed=feed)

    missing = checked.where(~F.col("present")).select("key")
    payloads = windows.batch_payloads(windows.make_batches(missing, batch_size, part_rows))
    batches = materialize(payloads, "replay-batches")
    waves = max(1, -(-batches.count() // (wave_batches or 10 * concurrency)))
    wave = F.pmod(F.xxhash64("batch"), F.lit(waves)).cast("int")
    for i in range(waves):
        answered = deliver(batches.where(wave == i), sender, concurrency)
        append_outcomes(answered, path, run, feed, part=i + 1)
    return read_outcomes(spark, path, OUTCOMES).where((F.col("feed") == feed) & (F.col("run") == run))
