"""Change records -> bronze envelopes (PRJ-01..03, FIL-01..02, SNK-04, AGG-13).

One pass per micro-batch or batch: pick the image, drop removes and empty
images, decode the tagged attributes against the target schema and wrap the
result in the envelope.  Records that cannot be decoded cleanly are kept
aside with an error text instead of failing the batch.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.decode import bad_sets, decode_attributes, image_size, raw_numbers
from ..schemas import CDC_ENVELOPE, ITEM
from ..sources.fixtures import TABLE_NAME


def select_image(df: DataFrame) -> Column:
    """INSERT/MODIFY -> NewImage; any other event -> OldImage (PRJ-01)."""
    return F.when(F.col("eventName").isin("INSERT", "MODIFY"), F.col("dynamodb.NewImage")) \
        .otherwise(F.col("dynamodb.OldImage"))


def not_removed() -> Column:
    """FIL-01: drop REMOVE; a null event name survives."""
    return ~F.col("eventName").eqNullSafe("REMOVE")


def has_image(image: Column) -> Column:
    """FIL-02: image present and not ``{}``.

    Every stored item has a partition key, so an image with ``PK`` is
    non-empty without counting its attributes; only images lacking it pay
    for the full size check (``OR`` short-circuits in generated code).
    """
    has_pk = F.try_variant_get(image, "$['PK']", "variant").isNotNull()
    return image.isNotNull() & (has_pk | (image_size(image) > 0))


MALFORMED = "malformed record"
BAD_SET = "unparseable number in a set"


def classify(changes: DataFrame, schema=ITEM) -> DataFrame:
    """Tag every change: ``_outcome`` is processed / skipped / failed.

    skipped = removes and empty images (the handler returns nothing for
    them); failed = a line that is no record, or a number set with an element
    that does not parse (kept with ``_error``).  A single number that does
    not parse keeps its text and the record is processed.  Input columns are
    kept, plus ``_image``.
    """
    img = select_image(changes)
    staged = changes.withColumn("_image", img)
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in changes.columns else F.lit(False)
    err = F.when(corrupt, F.lit(MALFORMED)).when(bad_sets(F.col("_image")), F.lit(BAD_SET))
    outcome = (F.when(corrupt, F.lit("failed"))
               .when(~not_removed(), F.lit("skipped"))
               .when(~has_image(F.col("_image")), F.lit("skipped"))
               .when(err.isNotNull(), F.lit("failed"))
               .otherwise(F.lit("processed")))
    return staged.withColumn("_error", err).withColumn("_outcome", outcome)


def to_envelope(df: DataFrame, table_name: str = TABLE_NAME, now: Column | None = None,
                schema=ITEM) -> DataFrame:
    """Decode ``_image`` and build the bronze envelope (PRJ-03).

    ``processed_at`` is the arrival time: the clock, one value per run, or
    ``now`` when given (tests and registered queries pin it).
    partition_key = data.PK when present.
    """
    # rows reaching the envelope always carry an image: bare struct, so the
    # optimizer decodes only the attributes that downstream plans read
    data = decode_attributes(F.col("_image"), schema, null_image_is_null=False)
    processed = now if now is not None else F.current_timestamp()
    out = df.select(
        F.col("eventName").alias("event_name"),
        F.col("eventTime").alias("event_time"),
        F.col("dynamodb.SequenceNumber").alias("sequence_number"),
        F.lit(table_name).alias("table_name"),
        processed.cast("timestamp").alias("processed_at"),
        data.alias("data"),
        raw_numbers(F.col("_image"), schema).alias("raw"),
    ).withColumn("partition_key", F.col("data.PK"))
    return out.select(*[f.name for f in CDC_ENVELOPE.fields])


def changes_to_bronze(changes: DataFrame, table_name: str = TABLE_NAME, now: Column | None = None) -> DataFrame:
    """Processed changes only, as envelopes (the stream handler's output).

    A plain filter: on a file source the image is an input column, so the
    pushed-down condition is cheap, and the optimizer decodes only the
    attributes that downstream plans read.
    """
    c = classify(changes)
    return to_envelope(c.filter(F.col("_outcome") == "processed"), table_name, now)


def split_quarantine(changes: DataFrame, table_name: str = TABLE_NAME, now: Column | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """(good envelopes, failed records with error text)."""
    c = classify(changes)
    return to_envelope(c.filter(F.col("_outcome") == "processed"), table_name, now), failed_records(c)


def failed_records(classified: DataFrame) -> DataFrame:
    """SNK-04: the failed records of a classified batch: what came, and why it failed."""
    text = F.to_json(F.col("_image"))
    if "_corrupt_record" in classified.columns:
        text = F.coalesce(F.col("_corrupt_record"), text)
    return classified.filter(F.col("_outcome") == "failed").select(
        "eventName", "eventTime", F.col("dynamodb.SequenceNumber").alias("sequence_number"),
        text.alias("record"), F.col("_error").alias("error"))


def count_outcomes(classified: DataFrame, *keys: str) -> DataFrame:
    """processed / failed / skipped counts of a classified batch (AGG-13), one aggregate."""
    return classified.groupBy(*keys).agg(*_outcome_counts())


def observe_outcomes(classified: DataFrame, seen: Observation) -> DataFrame:
    """The classified batch; ``seen`` gets its counts (AGG-13) when it is written, without a pass of their own."""
    return classified.observe(seen, *_outcome_counts())


def observed_outcomes(classified: DataFrame, seen: Observation) -> dict:
    """What ``observe_outcomes`` saw."""
    try:
        return seen.get
    except (PySparkException, Py4JError):
        # no record: an adaptive plan leaves out what is empty, and its observation
        return count_outcomes(classified).first().asDict()


def _outcome_counts() -> list[Column]:
    return [*[F.count_if(F.col("_outcome") == o).alias(o) for o in ("processed", "failed", "skipped")], F.count(F.lit(1)).alias("records")]


def batch_counters(changes: DataFrame, batch_col: str | None = None) -> DataFrame:
    """processed / failed / skipped counts per batch (AGG-13)."""
    return count_outcomes(classify(changes), *([batch_col] if batch_col else []))


def delivery_failures(failed: DataFrame) -> DataFrame:
    """Failure count per error text (AGG-14) over quarantined records."""
    return failed.groupBy(F.col("error")).agg(F.count(F.lit(1)).alias("failed"))
