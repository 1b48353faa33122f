"""Secrets in texts, told from examples by how widely they are copied.

Candidates are found inside each text by regular expressions.  Their hashes are then
counted over the whole corpus by distinct owners and, where there is a column of them,
repositories: a value that many owners hold is an example that was copied around, one
that stays with few looks live.  Base kinds are always reported; the further kinds only where the
counts say live.

Everything here is DataFrame functions.  The table that is written and joined holds
positions and hashes, not texts (unless the caller keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardbrook.llm.common import whole_text
from shardbrook.storage import store

# Kind, pattern, group of the value, least length of the value.  A match whose value is
# shorter is dropped after matching, so what it covers stays covered.
BASE_KINDS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
MORE_KINDS = [
    (
        "opaque",
        r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{24,}",
        0,
        24,
    ),
    ("web-token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 20),
    # To the end of its own name, before that of another, or to the end of the text.
    (
        "key-block",
        r"(?s)-----BEGIN ((?:[A-Z0-9]+ )*?PRIVATE KEY(?: BLOCK)?)-----"
        r".*?(?:-----END \1-----|(?=-----END )|(?=-----END\z)|\z)",
        0,
        20,
    ),
]
ORDER = {name: i for i, (name, *_) in enumerate(BASE_KINDS + MORE_KINDS)}
# Held by more owners, or more repositories, than these, a value is a copied example.
# Without repositories (``repository_col=None``) only owners are counted.
MOST_OWNERS = 2
MOST_REPOSITORIES = 8
MASK = "[secret]"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Structs ``start, order, end, value`` of one kind; code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # What stands before each match; the last part has no match after it.
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(
        gaps,
        F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda gap, m: F.struct(
            F.length(gap).alias("gap"), F.length(m["w"]).alias("long"), m["v"].alias("value")
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,order:int,end:bigint,value:string>>")
    walked = F.aggregate(
        F.slice(steps, 1, F.size(whole)),
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["long"]).alias("at"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + s["gap"]).alias("start"),
                        F.lit(ORDER[kind]).alias("order"),
                        (acc["at"] + s["gap"] + s["long"]).alias("end"),
                        s["value"].alias("value"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    # Most texts have none; they are only searched once.
    found = F.when(text.rlike(pattern), F.filter(walked, lambda s: F.length(s["value"]) >= least))
    return F.coalesce(found, empty)


def candidates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``_row, _id, _owner, _repository, keep..., _base, _more``: spans with hashed values.

    ``_row`` numbers the rows of this table; it is only good for a stored one.
    Without a ``repository_col``, ``_repository`` is null.
    """
    repository = F.lit(None).cast("string")
    if repository_col is not None:
        repository = F.coalesce(F.col(repository_col).cast("string"), F.lit(""))
    parts = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("_owner"),
        repository.alias("_repository"),
        *keep,
        whole_text(text_col).alias("_whole"),
    )

    def hashed(kinds: list) -> Column:
        spans = F.concat(*(_spans(F.col("_whole"), *kind) for kind in kinds))
        return F.array_sort(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    s["order"].alias("order"),
                    s["end"].alias("end"),
                    F.xxhash64(s["value"]).alias("hash"),
                ),
            )
        )

    return parts.withColumns({"_base": hashed(BASE_KINDS), "_more": hashed(MORE_KINDS)}).drop("_whole")


def ownership(found: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: how many hold each candidate; null repositories
    do not count.

    Repeats are combined in each task first, then by (value, owner, repository), so a
    value that a third of the corpus holds is never gathered in one place.
    """
    held = (
        found.select("_owner", "_repository", F.explode(F.concat("_base", "_more")).alias("s"))
        .select(F.col("s.hash").alias("hash"), "_owner", "_repository")
        .distinct()
    )
    by_owner = held.groupBy("hash", "_owner").agg(F.count("_repository").alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("n").alias("repositories")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(name) for name in ORDER))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str | None = None,
    keep: tuple[str, ...] = (),
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """Spans of every row, base kinds and those that the corpus says are live.

    Returns ``id_col, keep..., n_assign, n_access, n_hex, base, spans, n_live, n_copied,
    places``: ``base`` and ``spans`` list ``kind:start:end`` (code points, end
    exclusive) by start and then kind; ``places`` are all of those spans as structs;
    ``n_live`` and ``n_copied`` count the base spans and further candidates on either
    side of the limits.  A live further span is only left out where base spans cover
    all of it, so spans may overlap.

    A null or empty text has no spans.  A null owner counts as one owner, a null
    repository as one repository.  Without a ``repository_col`` a value is judged by its
    owners alone, however many texts of theirs hold it; a text is no repository.  Rows with null or repeated ids are each searched
    and come back once each.  Columns not named are not read.

    Texts without a candidate are not shuffled; the others meet the counts by hash,
    in a join whose hot values Spark splits.
    """
    found = store(
        candidates(
            docs,
            id_col=id_col,
            text_col=text_col,
            owner_col=owner_col,
            repository_col=repository_col,
            keep=keep,
        ),
        "secrets",
    )
    counted = ownership(found)
    each = found.select(
        "_row",
        F.inline(
            F.concat(
                F.transform("_base", lambda s: s.withField("more", F.lit(False))),
                F.transform("_more", lambda s: s.withField("more", F.lit(True))),
            )
        ),
    )
    copied = (F.col("owners") > most_owners) | (F.col("repositories") > most_repositories)
    span = F.struct("start", "order", "end", "hash")
    judged = (
        each.join(counted, "hash")
        .groupBy("_row")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("more") & ~copied, span))).alias("_live"),
            F.count_if(~copied).alias("n_live"),
            F.count_if(copied).alias("n_copied"),
        )
    )
    none = F.lit(0).cast("long")
    bare = F.size("_base") + F.size("_more") == 0
    told = (
        found.where(~bare)
        .join(judged, "_row")
        .unionByName(
            found.where(bare).withColumns({"_live": F.col("_base"), "n_live": none, "n_copied": none})
        )
    )

    def covered(s: Column) -> Column:
        """Whether base spans, which are sorted by start, hold all of a further one."""
        return s["end"] <= F.aggregate(
            "_base",
            s["start"],
            lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at),
        )

    added = F.filter("_live", lambda s: ~covered(s))
    result = told.withColumn("places", F.array_sort(F.concat("_base", added)))

    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["order"] == ORDER[kind])).cast("long")

    return result.select(
        F.col("_id").alias(id_col),
        *keep,
        *(number(kind).alias(f"n_{kind}") for kind, *_ in BASE_KINDS),
        _listed(F.col("_base")).alias("base"),
        _listed(F.col("places")).alias("spans"),
        "n_live",
        "n_copied",
        "places",
    )


def masked(text: Column, places: Column, mask: str = MASK) -> Column:
    """The text with each run of overlapping spans replaced by ``mask``.

    ``places`` are sorted by start, as ``find_secrets`` gives them.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(acc["out"], before, F.lit(mask))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    rest = F.lit(2**31 - 1)
    return F.when(
        F.size(places) > 0,
        F.aggregate(
            places,
            start,
            step,
            lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), rest)),
        ),
    ).otherwise(text)
