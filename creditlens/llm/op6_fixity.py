"""Merkle fixity audit of WARC replicas.

A record's hash is the SHA-256 of its offset, its length and the SHA-256 of its bytes.  A leaf is
a fixed range of ``WIDTH`` bytes of a file, numbered by its place, and hashes the records that
start in it: a record that is missing, extra or longer changes its own range and no other.  Nodes
cover ``FANOUT`` children in the order of their offsets, up to one root for a file, and on to
one root for all files; a node's hash covers the bytes of the records below it.  Two replicas are
compared from the root: where two nodes agree nothing below is read; where they differ their
children are joined, down to the ranges.  Only the records of ranges that differ are read, and
matched with each other.

Defined results: a null html or url is empty; records are ordered by their offset in their
file, page_id (nulls first) and digest, and equal rows are records of their own; a record that
the second replica lacks is ``missing``, one that only it has is ``extra``, one with the same
bytes at another offset is ``moved``; an empty table has no roots and no faults; other columns
are not read.  Where a table has no ``start``, offsets are not compared: records are ordered by
page_id and digest, each record is a leaf of its own, and a replica's record takes the place of
its like.  A record without an offset in a table that has them belongs to the first range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlens.llm.shared import written

FANOUT = 16
RECORDS = 2048  # of a file, about
WIDTH = 1 << 13  # bytes of a leaf


def record(url: Column, html: Column) -> Column:
    """The text of a WARC response record."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def number(col: Column, salt: str) -> Column:
    """A number from 0 to 65535 that depends on the value alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(col.cast("string"), F.lit("")))), 1, 4), 16, 10).cast("long")


def hashed(records: DataFrame) -> DataFrame:
    """(file, page_id, start, length, digest) from (file, page_id, record), or from (file, page_id, length, digest); start is null where there is none."""
    if "record" in records.columns:
        records = records.withColumn("length", F.octet_length("record")).withColumn("digest", F.sha2("record", 256))
    start = F.col("start") if "start" in records.columns else F.lit(None)
    return records.select("file", F.col("page_id").cast("long"), start.cast("long").alias("start"), F.col("length").cast("long"), "digest")


def end_to_end() -> Column:
    """The offsets of records that lie end to end, in order of page_id and digest."""
    by = Window.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest")  # a file's records: about RECORDS
    return F.coalesce(F.sum("length").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")


def leaves(records: DataFrame) -> DataFrame:
    """(file, seq, page_id, start, length, digest, at) of each record; at is its own offset, null where the table has none."""
    own = hashed(records)
    by = Window.partitionBy("file").orderBy("start", F.col("page_id").asc_nulls_first(), "digest")
    start = F.col("start") if "start" in records.columns else end_to_end()
    return own.select("file", (F.row_number().over(by) - 1).cast("long").alias("seq"), "page_id", start.alias("start"), "length", "digest", F.col("start").alias("at"))


def depths(*leaf: DataFrame) -> tuple[int, int]:
    """Levels within the files and above them that the largest seq and file of all replicas need."""
    most = [x.agg(F.max("seq"), F.max("file")).first() for x in leaf]
    return tuple(next(k for k in range(64) if FANOUT**k > max(m[i] or 0 for m in most)) for i in (0, 1))


def ranges(records: DataFrame, width: int = WIDTH) -> DataFrame:
    """Leaves (file, seq, at, length, digest) of ``width`` bytes from placed records; seq is a range's number, at and length the bytes of its records."""
    own = F.struct(F.coalesce("at", F.lit(-1)).alias("at"), "length", "digest")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(own)), lambda x: F.concat_ws(":", x["at"], x["length"], x["digest"])), ",")
    lo, hi = F.min("at"), F.max(F.col("at") + F.col("length"))
    return records.groupBy("file", _range(width)).agg(F.coalesce(lo, F.lit(0)).alias("at"), F.coalesce(hi - lo, F.lit(0)).alias("length"), F.sha2(text, 256).alias("digest"))


def _range(width: int) -> Column:
    return F.expr(f"coalesce(at, 0) div {int(width)}").alias("seq")


def tree(leaf: DataFrame, inner: int, outer: int) -> list[DataFrame]:
    """Levels from the records up: (file, node, mark, lo, hi, up_file, up_node), up naming the node above.

    mark is what is compared, lo and hi the bytes covered (null without offsets).  Nodes above
    the files have -1 as file, and the bytes of all their files.
    """
    def linked(nodes: DataFrame, level: int) -> DataFrame:
        if level < inner:
            up = F.col("file"), F.expr(f"node div {FANOUT}")
        else:
            up = F.lit(-1).cast("long"), F.expr(f"{'file' if level == inner else 'node'} div {FANOUT}")
        return written(nodes.withColumn("up_file", up[0]).withColumn("up_node", up[1]))

    placed = F.sha2(F.concat_ws(":", "at", "length", "digest"), 256)
    out = [linked(leaf.withColumnRenamed("seq", "node").withColumn("mark", F.when(F.col("at").isNull(), F.col("digest")).otherwise(placed))
                  .withColumn("lo", F.col("at")).withColumn("hi", F.col("at") + F.col("length")), 0)]
    for level in range(1, inner + outer + 1):
        children = F.array_sort(F.collect_list(F.struct("file", "node", "mark")))  # FANOUT of them at most
        text = F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["file"].cast("string"), x["node"].cast("string"), x["mark"])), ",")
        lo, hi = (F.min("lo"), F.max("hi")) if level <= inner else (F.min("lo") * 0, F.sum(F.col("hi") - F.col("lo")))
        nodes = out[-1].groupBy("up_file", "up_node").agg(text.alias("text"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
        nodes = nodes.withColumn("mark", F.sha2(F.concat_ws("|", "lo", "hi", "text"), 256))
        out.append(linked(nodes.select(F.col("up_file").alias("file"), F.col("up_node").alias("node"), "mark", "lo", "hi"), level))
    return out


def compare(first: list[DataFrame], second: list[DataFrame]) -> tuple[DataFrame, list[int]]:
    """The records that differ, and how many nodes were compared at each level from the root down."""
    wrong, compared = None, []
    for a, b in zip(reversed(first), reversed(second)):
        if wrong is not None:
            above = wrong.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            a, b = (x.join(above, ["up_file", "up_node"], "left_semi") for x in (a, b))
        a, b = (x.drop("up_file", "up_node").select("file", "node", *[F.col(c).alias(f"{n}_{c}") for c in x.columns if c not in ("file", "node", "up_file", "up_node")])
                for n, x in (("a", a), ("b", b)))
        both = written(a.join(b, ["file", "node"], "full"))
        compared.append(both.count())
        wrong = both.filter(~F.col("a_mark").eqNullSafe(F.col("b_mark")))
    return wrong, compared


def descend(here: DataFrame, there: DataFrame, width: int = WIDTH) -> tuple[DataFrame, list[int]]:
    """(file, node) of the ranges in which two replicas' placed records differ, and the nodes compared at each level."""
    one, two = written(ranges(here, width)), written(ranges(there, width))
    levels = depths(one, two)
    wrong, compared = compare(tree(one, *levels), tree(two, *levels))
    return written(wrong.select("file", "node")), compared


def _audit_places(first: DataFrame, second: DataFrame, width: int) -> DataFrame:
    here, there = written(leaves(first)), written(leaves(second))
    wrong, _ = descend(here, there, width)
    names = ("page_id", "start", "length", "digest")
    a, b = (x.withColumn("node", _range(width)).join(wrong, ["file", "node"], "left_semi").select("file", "seq", *names) for x in (here, there))
    # records of differing ranges: equal ones go, then the same bytes are matched, then the same page_id
    pairs = None
    for by in (names, ("page_id", "digest"), ("page_id",)):
        turn = Window.partitionBy("file", *by).orderBy("start", "seq")
        left, right = (x.withColumn("turn", F.row_number().over(turn)).select(*[F.col(c).alias(f"{n}_{c}") for c in ("file", "seq", "turn", *names)]) for n, x in (("a", a), ("b", b)))
        same = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in ("file", "turn", *by)]
        met = written(left.join(right, same, "full"))
        both = met.filter("a_seq is not null and b_seq is not null")
        if by != names:
            pairs = both if pairs is None else pairs.unionByName(both)
        a, b = (met.filter(f"{y}_seq is null").select(*[F.col(f"{x}_{c}").alias(c) for c in ("file", "seq", *names)]) for x, y in (("a", "b"), ("b", "a")))
    single = met.filter("a_seq is null or b_seq is null")
    last = here.groupBy(F.col("file").alias("l_file")).agg(F.max("seq").alias("last"))
    behind = F.row_number().over(Window.partitionBy("b_file").orderBy("b_start", "b_seq"))
    extra = (single.filter("a_seq is null").withColumn("behind", behind).join(last, F.col("b_file") == F.col("l_file"), "left")
             .withColumn("a_seq", (F.coalesce("last", F.lit(-1)) + F.col("behind")).cast("long")).drop("behind", "l_file", "last"))
    found = pairs.unionByName(single.filter("b_seq is null")).unionByName(extra)
    return found.select(F.coalesce("a_file", "b_file").alias("file"), F.col("a_seq").alias("seq"), F.coalesce("a_page_id", "b_page_id").alias("page_id"), F.col("a_start").alias("start"),
                        F.col("a_length").alias("length"),
                        F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").when(F.col("a_digest") == F.col("b_digest"), "moved")
                        .otherwise("changed").alias("found"),
                        F.col("a_digest").alias("expected_sha256"), F.col("b_digest").alias("found_sha256"))


def audit(first: DataFrame, second: DataFrame, width: int = WIDTH) -> DataFrame:
    """(file, seq, page_id, start, length, found, expected_sha256, found_sha256) of every record that differs.

    first: (file, page_id, start, record), or length and digest in place of the record;
    second: the same, a replica, with offsets of its own.  seq, start and length are the
    first's.  Without ``start`` in both, a replica's record takes the place of the first's
    record with its file and page_id.  ``width``: bytes of a leaf.
    """
    if "start" in first.columns and "start" in second.columns:
        return _audit_places(first, second, width)
    here = written(leaves(first.drop("start")))
    other = hashed(second).drop("start")
    # equal page_ids are matched in order of digest; a record that only the replica has goes behind the file's last
    turn = Window.partitionBy("file", "page_id").orderBy("digest")
    a = here.withColumn("turn", F.row_number().over(turn)).select(F.col("file").alias("f"), F.col("page_id").alias("p"), "turn", "seq", "start")
    b = other.withColumn("turn", F.row_number().over(turn))
    matched = b.join(a, (F.col("file") == F.col("f")) & F.col("page_id").eqNullSafe(F.col("p")) & (a["turn"] == b["turn"]), "left").drop("f", "p", "turn")
    last = here.groupBy(F.col("file").alias("l_file")).agg(F.max("seq").alias("last"))
    behind = F.row_number().over(Window.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest"))
    extra = (matched.filter("seq is null").join(last, F.col("file") == F.col("l_file"), "left")
             .select("file", (F.coalesce("last", F.lit(-1)) + behind).cast("long").alias("seq"), "page_id", F.lit(None).cast("long").alias("start"), "length", "digest"))
    there = matched.filter("seq is not null").select("file", "seq", "page_id", "start", "length", "digest").unionByName(extra)
    there = written(there.withColumn("at", F.lit(None).cast("long")))
    levels = depths(here, there)
    wrong, _ = compare(tree(here, *levels), tree(there, *levels))
    return wrong.select("file", F.col("node").alias("seq"), F.coalesce("a_page_id", "b_page_id").alias("page_id"), F.col("a_start").alias("start"),
                        F.col("a_length").alias("length"),
                        F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").otherwise("changed").alias("found"),
                        F.col("a_digest").alias("expected_sha256"), F.col("b_digest").alias("found_sha256"))
