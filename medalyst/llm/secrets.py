"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern. A candidate value seen under many owners (README keys, fixtures, vendored samples) is a
copied example; one seen under a few is a live-looking credential of its owner. A value is hashed before it is shuffled.

Defined cases: NULL text is empty and has no spans; a NULL owner or repository counts as one owner or repository of its own;
repeated rows give repeated, equal results; an empty table gives an empty result; other columns are ignored, whatever
their names. Positions are code points, end exclusive. Spans that start together are ordered as the kinds are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.session import durable

# Kind, pattern, group of the secret, least length of that group.
# A run of [0-9a-f] or of AKIA[A-Z0-9] is taken whole, so asking for its least length in the pattern finds the same spans.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Wider candidates: reported only where ownership shows that they are live.
WIDER = (
    ("provider", r"(?:gh[opsu]_|glpat-|xox[abp]-|sk_live_|rk_live_|sk-)[A-Za-z0-9_-]{16,}", 0, 20),
    ("bearer", r"""(?i:bearer|credential|private_?key|access_?key|auth)["']?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_.=-]{20,})""", 1, 20),
)
KINDS = [kind for kind, *_ in BASE + WIDER]
SPAN = "struct<start:int,kind:int,end:int,from:int,value:string>"
MASK = "[SECRET]"


def found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind as array of (start, kind, end, start of the secret, secret)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), inner.alias("inner"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["whole"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                        (end - F.length(piece["inner"])).alias("from"), piece["inner"].alias("value"))
        kept = F.when(F.length(piece["inner"]) >= least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(F.coalesce(end, start).alias("at"), kept.alias("out"))

    walk = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda state: state["out"])
    return F.when(text.rlike(pattern), walk).otherwise(none)


def _outside(spans: Column, base: Column) -> Column:
    """Spans that touch no base span."""
    return F.filter(spans, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: Column | None = None,
         owner: Column | None = None) -> DataFrame:
    """``doc_id, text_key, base, wider, owner, repository`` per row: what the patterns find, before any counting."""
    body = F.coalesce(F.col(text), F.lit(""))
    wide = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body, F.crc32(body)).alias("text_key"),
                       F.array_sort(F.concat(*[found(body, *kind) for kind in BASE])).alias("base"),
                       F.array_sort(F.concat(*[found(body, *kind) for kind in WIDER])).alias("wider"),
                       (F.lit(None).cast("string") if owner is None else owner.cast("string")).alias("owner"),
                       (F.lit(None).cast("string") if repository is None else repository.cast("string")).alias("repository"))
    return wide.withColumn("wider", _outside(F.col("wider"), F.col("base")))


def ownership(scanned: DataFrame) -> DataFrame:
    """``value_hash, owners, repositories``: in how many places each candidate value occurs.

    Equal (value, owner, repository) rows are merged before they are counted, so a value that fills a third of the corpus
    costs one row per place and task.
    """
    places = (scanned.select("owner", "repository", F.explode(F.concat("base", "wider")).alias("span"))
              .select(F.sha2("span.value", 256).alias("value_hash"), F.struct("owner").alias("owner"),
                      F.struct("owner", "repository").alias("place"))
              .distinct())
    return (places.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("places"))
            .groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("places").alias("repositories")))


def verdicts(scanned: DataFrame, copied_owners: int) -> DataFrame:
    """``_id, _key, copied``: per distinct document, the hashes of its candidates that many owners share."""
    shared = ownership(scanned).where(F.col("owners") >= copied_owners).select("value_hash")
    held = (scanned.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                           F.explode(F.concat("base", "wider")).alias("span"))
            .select("_id", "_key", F.sha2("span.value", 256).alias("value_hash")).distinct())
    return held.join(shared, "value_hash").groupBy("_id", "_key").agg(F.collect_list("value_hash").alias("copied"))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: Column | None = None,
           owner: Column | None = None, copied_owners: int = 3) -> DataFrame:
    """Per row ``doc_id, text_key, base, added, live, copied``.

    ``added`` are wider candidates that look live; ``live`` the spans, base or added, whose value fewer than
    ``copied_owners`` owners have; ``copied`` the base spans that more have.
    """
    scanned = durable(scan(docs, doc_id, text, repository, owner))
    marks = verdicts(scanned, copied_owners)
    joined = scanned.join(marks, scanned["doc_id"].eqNullSafe(marks["_id"]) & (scanned["text_key"] == marks["_key"]), "left")
    shared = F.coalesce(F.col("copied"), F.array().cast("array<string>"))
    live = lambda spans: F.filter(spans, lambda x: ~F.array_contains(shared, F.sha2(x["value"], 256)))
    return joined.select("doc_id", "text_key", "base", live(F.col("wider")).alias("added"),
                         F.array_sort(F.concat(live(F.col("base")), live(F.col("wider")))).alias("live"),
                         F.array_except("base", live(F.col("base"))).alias("copied"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def report(found_rows: DataFrame) -> DataFrame:
    """The digest of ``judged``: counts, the hash of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("bigint")
    return found_rows.select(
        "doc_id", *[of(kind).alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("live").cast("bigint").alias("n_live"), F.size("copied").cast("bigint").alias("n_copied"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with the secret part of each span replaced; overlapping parts are replaced once."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        fresh = x["from"] >= state["at"]
        head = F.concat(state["out"], F.substring(text, state["at"] + 1, x["from"] - state["at"]), F.lit(MASK))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(fresh, head).otherwise(state["out"]).alias("out"))

    return F.aggregate(F.array_sort(F.transform(spans, lambda x: F.struct(x["from"].alias("from"), x["end"].alias("end")))),
                       zero, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: Column | None = None,
           owner: Column | None = None, copied_owners: int = 3) -> DataFrame:
    """``docs`` with every live-looking secret masked in ``text``; copied examples and all other columns stay."""
    marks = (judged(docs, doc_id, text, repository, owner, copied_owners).where(F.size("live") > 0)
             .select(F.col("doc_id").alias("_secret_id"), F.col("text_key").alias("_secret_key"), F.col("live").alias("_live"))
             .dropDuplicates(["_secret_id", "_secret_key"]))
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn("_body_key", F.xxhash64(body, F.crc32(body)))
    joined = keyed.join(marks, keyed[doc_id].eqNullSafe(marks["_secret_id"]) & (keyed["_body_key"] == marks["_secret_key"]), "left")
    return (joined.withColumn(text, F.when(F.col("_live").isNotNull(), masked(F.col(text), F.col("_live"))).otherwise(F.col(text)))
            .select(*docs.columns))
