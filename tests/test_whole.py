"""Queries read whole tables and whole texts: what lies beyond a small prefix counts too."""

import collections
import datetime

from folioflow import plans
from folioflow.operators import lines, structure


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_optional_revoker_of_all_orders(spark, tmp_path):
    keys = (4999, 5000, 5002, 10000, 10004)
    d = write(spark, tmp_path, "orders", [(k,) for k in keys], "o_orderkey long")
    got = {tuple(r) for r in plans.QUERIES["j19_optional_revoker"](spark, d).select("o_orderkey", "revoker", "state").collect()}
    assert got == {(k, 10000 if k == 5000 else None, "revoked" if k == 5000 else "in force") for k in keys}


def test_missing_years_of_all_lines(spark, tmp_path):
    keys = [1, 30, 41, 90]
    d = write(spark, tmp_path, "lineitem", [(k,) for k in keys], "l_suppkey long")
    got = [r["y"] for r in plans.QUERIES["s5_missing_years"](spark, d).collect()]
    assert got == sorted(set(range(3, 271)) - {3 * k for k in keys})


def test_line_categories_of_whole_texts(spark, tmp_path):
    lines = {"- 12 -": "page_number", "Presiden": "institution", "Nomor 3": "number", "www.x.id": "url", "HEADING": "heading", "some text": "text", "": "text"}
    texts = ["\n".join(lines), "\n".join([*reversed(lines)] * 3), "", None]
    d = write(spark, tmp_path, "documents", [(t,) for t in texts], "text string")
    got = {r["category"]: r["n"] for r in plans.QUERIES["f53_line_categories"](spark, d).collect()}
    assert got == collections.Counter(lines[x] for t in texts if t is not None for x in t.split("\n"))


def test_position_frequency_of_whole_texts(spark, tmp_path):
    docs = [(i, "en", "\n".join(["top"] + [f" line {i} {k} " for k in range(1, 40)] + ["bottom", "", f"tail {i % 2}"])) for i in range(150)] + [(150, "de", None)]
    d = write(spark, tmp_path, "documents", docs, "doc_id long, lang string, text string")
    got = {tuple(r) for r in plans.QUERIES["a28_position_frequency"](spark, d).select("lang", "pos", "line", "hits", "rank").collect()}
    hits = collections.defaultdict(collections.Counter)
    for _, _, text in docs[:-1]:
        for pos, line in enumerate(text.split("\n")):
            if line.strip(" "):
                hits[pos][line.strip(" ")] += 1
    expected = set()
    for pos, found in hits.items():
        for rank, (line, n) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:3], 1):
            if n / 150 > 0.01:
                expected.add(("en", pos, line, n, rank))
    assert max(x[1] for x in expected) == 42
    assert got == expected


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_error_rate_of_whole_texts(spark, tmp_path):
    texts = ["Short Text, 1!", "A" * 60 + " end of it", "mixed CASE text. " * 12, "x" * 200, "7", None]
    d = write(spark, tmp_path, "benchmark", list(enumerate(texts)), "item_id int, text string")
    got = {r["item_id"]: r["cer"] for r in plans.QUERIES["f46_error_rate"](spark, d).collect()}
    letters = ["".join(c for c in t or "" if c == " " or c.isascii() and c.isalpha()) for t in texts]
    assert got == {i: distance(a, a.upper()) / len(a) if a else None for i, a in enumerate(letters)}
    assert got[3] == 1


def test_paths_from_all_nodes(spark, tmp_path):
    keys = [*range(1, 140), 1024]
    d = write(spark, tmp_path, "orders", [(k,) for k in keys], "o_orderkey long")
    got = {tuple(r) for r in plans.QUERIES["j18_variable_length_path"](spark, d).select("start", "node", "steps").collect()}
    step = {k: k // 2 for k in keys if k % 2 == 0}
    expected = set()
    for start in step:
        node = start
        for steps in range(1, 5):
            if node not in step:
                break
            node = step[node]
            expected.add((start, node, steps))
    assert got == expected


def test_histogram_of_whole_vectors(spark, tmp_path):
    vectors = [[0.0] * 32 + [0.25] * 32, [0.1] * 40 + [0.005] * 24]
    d = write(spark, tmp_path, "embeddings", list(enumerate(vectors)), "vec_id int, embedding array<float>")
    got = {r["vec_id"]: (r["first_bin"], r["last_bin"]) for r in plans.QUERIES["m3_histogram"](spark, d).collect()}
    assert got == {0: (0.5, 0.5), 1: (0.375, 0)}


def test_lines_far_down_a_page_count_too(spark):
    """A function given to a higher-order function must not take the index for an option."""
    body = [f"line {i} of it" for i in range(40)]
    pages = spark.createDataFrame([("d", p, "\n".join([*body[: 20 + p], "HEAD 10203", "HEAD 1020300"])) for p in range(3)], "doc string, page int, text string")
    found = {r["line"]: r["hits"] for r in lines.repeated_lines(pages, "doc", "page").collect()}
    assert found["head 10203"] == found["head 1020300"] == 3 and found["line 19 of it"] == 3
    left = [r["clean"] for r in lines.drop_frequent_lines(pages, "doc", "page").orderBy("page").collect()]
    assert left == ["", "", "line 21 of it"]


def test_year_of_a_record_is_not_its_key(spark, tmp_path):
    """Key 2002 has neither title nor valid year: the year is that of the law, not the number in "law-2002"."""
    rows = [(k, 7, datetime.datetime(1998, 5, 15)) for k in (2002, 1001, 143, 26)]
    d = write(spark, tmp_path, "orders", rows, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    got = {r["slug"]: (r["tahun"], r["error"]) for r in plans.QUERIES["f1_f9_records"](spark, d).collect()}
    assert got == {"law-2002": (1998, "missing tentang"), "law-1001": (1998, "missing tentang"), "law-143": (1998, "missing tentang"), "law-26": (1986, None)}


def test_tree_totals_of_each_row(spark):
    """Totals are those of a row, also of repeated and missing keys, and take no exchange."""
    law = "BAB I\nUMUM\nPasal 1\n(1) Jenis:\na. logam\nb. bukan logam\n(2) Endapan.\nBAB II\nPENUTUP\nPasal 2\nSelesai.\n"
    loose = "Pasal 1\nIsi pasal ini.\nPasal 2\na. satu hal\nb. dua hal\nBAB I\nUMUM\nPasal 3\n(1) Satu.\n"
    docs = spark.createDataFrame([("x", law), ("x", law), (None, law), ("y", loose), ("z", "short"), ("n", None)], "slug string, text string")
    found = structure.totals(docs, "slug")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("x", 2, 2, 2), ("x", 2, 2, 2), (None, 2, 2, 2), ("y", 3, 2, 2), ("z", 0, 0, 0), ("n", 0, 0, 0)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
