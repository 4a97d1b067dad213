"""Merkle audits: planted faults, and how little is compared."""

from creditlens.llm import op6_fixity as m


def frame(spark, rows):
    return spark.createDataFrame(rows, "file long, page_id long, record string").selectExpr("*", "1 as seq", "2 as node")


def test_planted_faults(spark):
    rows = [(f, f * 1000 + i, f"record {f} {i} é" * (1 + i % 5)) for f in range(20) for i in range(90)] + [(3, None, "x"), (3, 3000, "twin"), (3, 3000, "twin")]
    other = [(f, p, r) for f, p, r in rows if p not in (5007, 11089)] + [(4, 99, "extra"), (33, 1, "own file")]
    other = [(f, p, r + "!" if p in (2000, 7045) else r) for f, p, r in other]
    found = m.audit(frame(spark, rows), frame(spark, other)).collect()
    assert sorted((r.file, r.page_id, r.found) for r in found) == sorted(
        [(2, 2000, "changed"), (7, 7045, "changed"), (5, 5007, "missing"), (11, 11089, "missing"), (4, 99, "extra"), (33, 1, "extra")])
    at = {r.page_id: r for r in found}
    assert at[7045].seq == 45 and at[7045].start == sum(len(r.encode()) for f, p, r in rows if f == 7 and p < 7045)
    assert m.audit(frame(spark, rows), frame(spark, rows)).count() == 0
    assert m.audit(frame(spark, []), frame(spark, [])).count() == 0
    assert m.audit(frame(spark, rows[:3]), frame(spark, [])).count() == 3


def test_compares_only_differing_branches(spark):
    rows = [(f, f * 1000 + i, f"record {f} {i}") for f in range(20) for i in range(90)]
    one = m.written(m.leaves(frame(spark, rows)))
    two = m.written(m.leaves(frame(spark, [(f, p, "changed" if p == 6050 else r) for f, p, r in rows])))
    inner, outer = m.depths(one, two)
    wrong, compared = m.compare(m.tree(one, inner, outer), m.tree(two, inner, outer))
    assert [r.a_page_id for r in wrong.collect()] == [6050]
    assert compared[0] == 1 and max(compared) <= m.FANOUT and compared[-1] <= m.FANOUT
    same = m.compare(m.tree(one, inner, outer), m.tree(one, inner, outer))
    assert same[1][1:] == [0] * (inner + outer)


def placed(rows):
    """Rows (file, page_id, record) laid end to end in each file, as (file, page_id, record, start)."""
    out, ends = [], {}
    for f, p, r in rows:
        out.append((f, p, r, ends.get(f, 0)))
        ends[f] = out[-1][3] + len(r.encode())
    return out


def test_offsets_of_the_replica(spark):
    def table(rows):
        return spark.createDataFrame(rows, "file long, page_id long, record string, start long")

    rows = placed([(f, (f * 1000 + i) * 7 % 30011, f"record {f} {i:02d} {'é' * (i % 3)}") for f in range(5) for i in range(60)] + [(2, None, "x"), (2, 9, "twin"), (2, 9, "twin")])
    at = {(f, p): i for i, (f, p, _, _) in enumerate(rows)}

    def faults(other):
        return sorted((r.file, r.page_id or 0, r.found, r.start) for r in m.audit(table(rows), table(other)).collect())

    assert faults(rows) == [] and faults(rows[::-1]) == []
    x, y = rows[70], rows[100]  # exchanged: of the same length, so that no other record moves
    assert len(x[2].encode()) == len(y[2].encode()) and x[0] == y[0]
    swapped = rows[:70] + [(*y[:3], x[3])] + rows[71:100] + [(*x[:3], y[3])] + rows[101:]
    assert faults(swapped) == sorted([(1, x[1], "moved", x[3]), (1, y[1], "moved", y[3])])
    late = [(f, p, r, s + 4 if (f, p) == rows[10][:2] else s) for f, p, r, s in rows]
    assert faults(late) == [(0, rows[10][1], "moved", rows[10][3])]
    shifted = [(f, p, r, s + 512 * (f == 3)) for f, p, r, s in rows]  # a whole file
    assert faults(shifted) == sorted((f, p, "moved", s) for f, p, _, s in rows if f == 3)
    gone = [r for i, r in enumerate(rows) if i not in (5, at[2, None], len(rows) - 1)] + [(4, 77, "own", 10**6), (9, 1, "own file", 0)]
    gone[50] = (*gone[50][:2], gone[50][2] + "!", gone[50][3])
    assert faults(gone) == sorted([(0, rows[5][1], "missing", rows[5][3]), (2, 0, "missing", rows[at[2, None]][3]), (2, 9, "missing", rows[-1][3]),
                                   (0, rows[51][1], "changed", rows[51][3]), (4, 77, "extra", None), (9, 1, "extra", None)])


def test_nodes_cover_their_bytes(spark):
    rows = [(f, i, "r" * 10, i * 10) for f in range(2) for i in range(40)]
    one, two = (m.leaves(spark.createDataFrame([(*r[:3], r[3] + 5 * n * (r[0] == 1)) for r in rows], "file long, page_id long, record string, start long")) for n in (0, 1))
    one, two = (m.tree(x, *m.depths(one)) for x in (one, two))
    assert [(r.lo, r.hi) for r in one[-1].collect()] == [(0, 800)]
    assert sorted((r.file, r.lo, r.hi) for r in two[2].collect()) == [(0, 0, 400), (1, 5, 405)]
    assert one[-1].first().mark != two[-1].first().mark


def test_missing_records_open_their_own_ranges_only(spark):
    schema = "file long, page_id long, start long, length long, digest string"
    rows = [(f, i, i * 900 + f, 880, f"{f}-{i}") for f in range(3) for i in range(2048)]
    gone = set(range(40, 2040, 100))  # 20 records of file 1
    one, two = (m.written(m.leaves(spark.createDataFrame(x, schema))) for x in (rows, [r for r in rows if r[0] != 1 or r[1] not in gone]))
    wrong, compared = m.descend(one, two)
    assert sorted((r.file, r.node) for r in wrong.collect()) == sorted({(1, (i * 900 + 1) // m.WIDTH) for i in gone})
    assert compared[-1] <= len(gone) * m.FANOUT and compared[0] == 1
    found = m.audit(spark.createDataFrame(rows, schema), spark.createDataFrame([r for r in rows if r[0] != 1 or r[1] not in gone], schema)).collect()
    assert sorted((r.file, r.page_id, r.found) for r in found) == [(1, i, "missing") for i in sorted(gone)]
    # a longer record before all others of its file: those behind it keep their offsets
    longer = [(f, i, s, n + (f == 2 and i == 0) * 5, d + "!" * (f == 2 and i == 0)) for f, i, s, n, d in rows]
    wrong, compared = m.descend(one, m.written(m.leaves(spark.createDataFrame(longer, schema))))
    assert [(r.file, r.node) for r in wrong.collect()] == [(2, 0)] and max(compared) <= m.FANOUT


def test_null_url_html_and_offset(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", None), (3, None, "<p>")], "page_id long, url string, html string")
    text = {r.page_id: r.r for r in pages.select("page_id", m.record(m.F.col("url"), m.F.col("html")).alias("r")).collect()}
    assert text[1] == "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: \r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert "Target-URI: u\r\n" in text[2] and "Content-Length: 3\r\n\r\n<p>\r\n" in text[3]
    schema = "file long, page_id long, record string, start long"
    rows = [(0, 1, "a", None), (0, 2, "b", 0), (0, 3, "c", 50000)]
    other = [(0, 1, "a!", None), *rows[1:]]
    assert m.audit(spark.createDataFrame(rows, schema), spark.createDataFrame(rows[::-1], schema)).count() == 0
    assert [(r.page_id, r.found) for r in m.audit(spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)).collect()] == [(1, "changed")]
