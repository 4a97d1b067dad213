"""Hash-chained review ledger (L1-L4).

The chain is kept per review (``review_id``) so that reviews hash in parallel;
inside one review, events are folded in ``seq`` order (a hash chain is
sequential by definition).  Verification and maker-checker rules are narrow
projections plus ``lag`` / ``first_value`` windows partitioned by review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.functions.columns import let
from creditlens.sources.adapters import REVIEW_DECISIONS, REVIEW_REASONS

GENESIS = "GENESIS"
# Canonical event document: keys in sorted order, compact separators.
HASH_KEYS = ("account_id", "actor", "created_at", "decision", "event", "previous_hash", "reason", "review_id")
EVENT_FIELDS = ("account_id", "actor", "created_at", "decision", "event", "reason")
ACCOUNT_PATTERN = r"^ACC-\d{6,}$"
MAX_ACTOR_LENGTH = 80


def _unicode_escape(code: Column) -> Column:
    """A backslash, u and four lower-case hex digits for a UTF-16 code unit."""
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def json_string(text: Column) -> Column:
    """A JSON string in ASCII, or null: every other character is escaped by its UTF-16 code units."""
    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        out = F.when(ch == '"', F.lit('\\"')).when(ch == "\\", F.lit("\\\\"))
        for raw, letter in (("\n", "n"), ("\r", "r"), ("\t", "t"), ("\b", "b"), ("\f", "f")):
            out = out.when(ch == raw, F.lit("\\" + letter))
        above = code - 0x10000
        pair = F.concat(_unicode_escape(F.shiftright(above, 10) + 0xD800), _unicode_escape(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
        return out.when(code > 0xFFFF, pair).when((code < 0x20) | (code > 0x7E), _unicode_escape(code)).otherwise(ch)

    plain = F.concat(F.lit('"'), text, F.lit('"'))
    escaped = F.concat(F.lit('"'), F.array_join(F.transform(F.split(text, ""), one), ""), F.lit('"'))
    return F.when(text.isNull(), F.lit("null")).when(text.rlike(r'[^ -~]|["\\]'), escaped).otherwise(plain)


def event_hash(src, previous_hash: Column) -> Column:
    """sha256 of the canonical JSON document of an event (incl. the previous hash); nulls are kept as null."""
    get = (lambda k: src[k]) if not isinstance(src, str) else (lambda k: F.col(k))
    parts = [F.concat(F.lit(f'"{k}":'), json_string(previous_hash if k == "previous_hash" else get(k))) for k in HASH_KEYS]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), 256)


def chain(events: DataFrame) -> DataFrame:
    """Append-chain every review: previous_hash / event_hash per event (L1)."""
    fields = ["seq", "review_id", *EVENT_FIELDS]
    grouped = events.groupBy("review_id").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in fields]))).alias("ev"))
    out_type = ("array<struct<seq:bigint,review_id:string," + ",".join(f"{c}:string" for c in EVENT_FIELDS)
                + ",previous_hash:string,event_hash:string>>")
    init = F.struct(F.lit(GENESIS).alias("last"), F.array().cast(out_type).alias("out"))

    def step(acc, e):
        return let(event_hash(e, acc["last"]), lambda h: F.struct(
            h.alias("last"),
            F.concat(acc["out"], F.array(F.struct(*[e[c].alias(c) for c in fields],
                                                  acc["last"].alias("previous_hash"), h.alias("event_hash"))))
             .alias("out")))
    folded = grouped.select(F.aggregate("ev", init, step)["out"].alias("out"))
    return folded.select(F.inline("out"))


def verify(ledger: DataFrame) -> DataFrame:
    """Broken links: recomputed hash differs, or previous_hash is not the prior event's hash (L2)."""
    w = Window.partitionBy("review_id").orderBy("seq")
    expected_prev = F.coalesce(F.lag("event_hash").over(w), F.lit(GENESIS))
    checked = ledger.select(
        "review_id", "seq",
        (event_hash("x", F.col("previous_hash")) != F.col("event_hash")).alias("hash_mismatch"),
        (F.col("previous_hash") != expected_prev).alias("link_mismatch"))
    return checked.filter(F.col("hash_mismatch") | F.col("link_mismatch"))


def violations(ledger: DataFrame) -> DataFrame:
    """Maker-checker rule violations as rows (review_id, seq, rule) (L3)."""
    w = Window.partitionBy("review_id").orderBy("seq")
    maker = F.first("actor").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    prev_event = F.lag("event").over(w)
    actor = F.trim(F.col("actor"))
    rules = [
        ("account_pattern", ~F.coalesce(F.col("account_id").rlike(ACCOUNT_PATTERN), F.lit(False))),
        ("maker_identity", (F.col("event") == "submitted")
         & ((F.coalesce(actor, F.lit("")) == "") | (F.length(F.col("actor")) > MAX_ACTOR_LENGTH))),
        ("governed_values", ~F.coalesce(F.col("decision").isin(*REVIEW_DECISIONS) & F.col("reason").isin(*REVIEW_REASONS), F.lit(False))),
        ("approval_state", (F.col("event") == "approved") & ~F.coalesce(prev_event == "submitted", F.lit(False))),
        ("distinct_checker", (F.col("event") == "approved")
         & ((F.coalesce(actor, F.lit("")) == "") | F.coalesce(F.lower(actor) == F.lower(F.trim(maker)), F.lit(False)))),
    ]
    flagged = ledger.select("review_id", "seq", F.array_compact(F.array(
        *[F.when(cond, F.lit(name)) for name, cond in rules])).alias("rules"))
    return flagged.select("review_id", "seq", F.explode("rules").alias("rule"))


def history(ledger: DataFrame) -> DataFrame:
    """Per review: events, first and last event, sequential review number (L4)."""
    w = Window.partitionBy("review_id").orderBy("seq")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = ledger.select(
        "review_id", F.count(F.lit(1)).over(full).alias("events"),
        F.first("event").over(full).alias("first_event"), F.last("event").over(full).alias("last_event"),
        F.row_number().over(w).alias("_rn"))
    return per.filter("_rn = 1").drop("_rn")
