"""Line dedup on hand-made documents, against its SQL and by hand."""

from pyspark.sql import functions as F

from tallymark.llm.line_dedup import dedup_lines

LINE = "This line is long enough to count"
ROWS = [
    (1, f"{LINE}\nshort\nown line one that is long enough"),
    (2, f"  {LINE.upper()}\t\n\nshort\n{LINE}"),
    (3, f"x\n{LINE}"),
    (4, None),
    (5, ""),
    (6, "short\nshort\nshort"),
    (7, "É" * 20 + "\n" + "é" * 20),
    (8, "\n".join([LINE] * 3 + [f"line number {i} of a long text" for i in range(20_000)])),
]


def digest(frame):
    return frame.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def test_matches_sql(spark, documents, same_as_sql):
    docs = documents(ROWS)
    same_as_sql("op4_line_dedup", digest(dedup_lines(docs)), documents=docs)


def test_only_the_largest_document_keeps_it(spark, documents):
    found = {r.doc_id: r for r in dedup_lines(documents(ROWS)).collect()}
    assert found[1].text == "short\nown line one that is long enough"
    assert found[2].text == "\nshort" and found[2].n_dropped == 2
    assert found[3].text == "x"
    assert found[4].text == "" and (found[4].n_lines, found[4].n_dropped) == (1, 0)
    assert found[8].n_dropped == 0


def test_columns_repeats_nulls_and_no_rows(spark, documents):
    rows = [(1, LINE, "en"), (1, LINE, "en"), (None, LINE, "de"), (2, LINE + "\nx", None)]
    docs = documents(rows).withColumnRenamed("source", "n_lines").withColumnRenamed("n_chars", "id")
    found = dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "lang", "id", "n_lines", "n_dropped"]
    # Null, 1 and 2 are three documents; 2 is the largest.
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(
        [(1, ""), (1, ""), (None, ""), (2, LINE + "\nx")], key=repr
    )
    assert dedup_lines(documents([])).collect() == []


def test_many_rows_without_an_id_and_clashing_names(spark, documents):
    # A third of all rows have no id; each line stays in the row of the largest id only.
    lines = [f"line number {i} that many rows share" for i in range(40)]
    rows = [(None, "\n".join(lines[i % 40 : i % 40 + 3])) for i in range(200)] + [(i, "\n".join(lines[i % 38 : i % 38 + 3])) for i in range(400)]
    docs = documents(rows).withColumnRenamed("lang", "hash").withColumnRenamed("source", "drops").withColumnRenamed("n_chars", "cut")
    found = dedup_lines(docs.withColumn("id", F.lit(1)).withColumn("line", F.lit(2)))
    assert found.columns == ["doc_id", "text", "hash", "drops", "cut", "id", "line", "n_lines", "n_dropped"]
    holders = {}
    for i, text in rows:
        for line in text.split("\n"):
            holders.setdefault(line, set()).add(-1 if i is None else i)
    for r in found.collect():
        assert all(max(holders[line]) == r.doc_id for line in r.text.split("\n") if line)
        assert r.n_lines == 3 or r.doc_id is None
