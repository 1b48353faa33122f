"""Ordering of sequence numbers, which are opaque strings of digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of the length that starts a key: enough for any string that Spark can hold
# in a row next to others (99,999,999 digits).
_PREFIX = 8

# Digits that fit a decimal whatever they are; Spark reduces decimals by hash.
_TAIL = 38
_NUMBER = f"decimal({_TAIL},0)"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def seq_key(sequence_number: Column | str) -> Column:
    """A text key that sorts sequence numbers: their length, then the number.

    Plain text order is wrong ('9' > '10') and no number type holds 56 digits or
    more.  Length first gives numeric order for numbers without leading zeros,
    and for numbers padded to one width.  The key is only eight bytes longer than
    the number, which matters because it is sorted and shuffled.
    """
    number = _col(sequence_number)
    return F.concat(F.lpad(F.octet_length(number).cast("string"), _PREFIX, "0"), number)


def number_of(key: Column | str) -> Column:
    """The sequence number a key was made from."""
    return F.substr(_col(key), F.lit(_PREFIX + 1))


def run_of(key: Column | str, digits: Column | int) -> Column:
    """The stretch of a shard a record lies in: its key without the last digits.

    It never decreases along a shard, and holds at most ``10 ** digits`` records
    where sequence numbers are unique.
    """
    key = _col(key)
    return F.substring(key, F.lit(1), F.greatest(F.octet_length(key) - digits, F.lit(0)))


def time_key(time: Column | str, tie: Column | str) -> Column:
    """A key like ``seq_key`` that sorts rows by a time and then by a whole number, above 0."""
    # Moved so that times before 1970 are no negative numbers.
    micros = F.unix_micros(_col(time).cast("timestamp")) + F.lit(10**18)
    return seq_key(
        F.concat(
            F.lpad(micros.cast("string"), 19, "0"),
            F.lpad(_col(tie).cast("bigint").cast("string"), 19, "0"),
        )
    )


def key_bounds(records: DataFrame, by: Sequence[str], key: str = "seq_key") -> DataFrame:
    """``by, first_key, last_key, n_records, n_keyless``: the ends of each group of records.

    Spark has no hash aggregate for the largest text; it would sort the whole log.
    So keys are cut into a head and their last 38 digits as a number: the numbers are
    reduced by hash, in each task first, and only what is left (a few heads per
    group, where numbers of a shard have the digits before those in common) is compared as
    text.  A null key is counted (in both numbers) and else left out; one whose last digits
    are not digits fails the job.
    """
    whole_key = F.col(key)
    tail = F.substring(whole_key, -_TAIL, _TAIL).cast(_NUMBER)
    heads = records.groupBy(
        *by, run_of(whole_key, _TAIL).alias("_head"), F.octet_length(whole_key).alias("_size")
    ).agg(F.min(tail).alias("_low"), F.max(tail).alias("_high"), F.count("*").alias("_n"))
    width = F.least(F.col("_size"), F.lit(_TAIL))

    def whole(tail: str) -> Column:
        return F.concat("_head", F.lpad(F.col(tail).cast("string"), width, F.lit("0")))

    return heads.groupBy(*by).agg(
        F.min(whole("_low")).alias("first_key"),
        F.max(whole("_high")).alias("last_key"),
        F.sum("_n").alias("n_records"),
        F.sum(F.when(F.col("_size").isNull(), F.col("_n")).otherwise(0)).alias("n_keyless"),
    )
