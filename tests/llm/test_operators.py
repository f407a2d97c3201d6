"""Operators against brute force on small texts, odd cases included."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.llm import decontamination, hilbert, html_paths, lengths, lines, mixing, ngram_join, outliers, subword, substrings
from folioflow.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tally(rows):
    return collections.Counter(tuple(r) for r in rows)


# words


def test_words_match_the_pattern():
    texts = ["a bc\n d", None, "", " \x0b x\x0cy ", "ünï ß", "w" * 10]
    w = W.Words(pa.array(texts))
    found = [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends, strict=True)]
    assert found == [x for t in texts for x in WORD.findall(t or "")]
    assert w.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]


def opposite_words(n):
    """The Thue-Morse word of n letters and its complement: equal under any polynomial hash modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_with_structure_do_not_collide(spark, n):
    x, y = opposite_words(n)
    w = W.Words(pa.array([f"{x} {y}"]))
    assert all(len({*w.hashes(lane).tolist()}) == 2 for lane in (0, 1))
    h = W.Words(pa.array([f"{' '.join(x)} {' '.join(y)}"])).hashes()
    assert len({*W.windows(h, n)[[0, n]].tolist()}) == 2
    rest = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, f"{x} {rest}", "a", "b"), (2, f"{y} {rest}", "a", "b"), (3, f"{x}\n{y}\n{rest}", "a", "b"), (4, x, "a", "b"), (5, y, "a", "b")], "doc_id bigint, text string, lang string, source string")
    assert {r["doc_id"]: r["n_dup_lines"] for r in outliers.quality_rules(df).collect()} == dict.fromkeys(range(1, 6), 0)
    assert {r["doc_id"]: r["n_removed"] for r in substrings.digests(df).collect()} == {1: 0, 2: 25, 3: 26, 4: 0, 5: 0}
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_hashes_do_not_depend_on_place_or_batch():
    a, b = W.Words(pa.array(["one two three one", "two"])), W.Words(pa.array(["x", "three two one"]))
    h, g = a.hashes(), b.hashes()
    assert h[0] == h[3] == g[3] and h[1] == h[4] == g[2] and len({*h.tolist()}) == 3
    long = W.Words(pa.array(["pad " * 700_000 + "one two"]))
    assert long.hashes()[-2:].tolist() == [h[0], h[1]]
    assert W.windows(np.arange(9, dtype=np.uint64), 3)[4] == W.windows(np.arange(4, 7, dtype=np.uint64), 3)[0]


# 1


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Site <a href=/>home</a></header>
<nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav><div class="ad banner">Buy now, today!</div>
<div id=wrap><article><h1>Head &amp; line</h1><p>First   para,\nwith marks.<p>Short.<div class="comment-list"><p>Great post, really, thanks.</p></div>
<script>if (a < b) "</p>"</script><ul><li>item one</li><li>item two</li></ul></article><aside>More, elsewhere.</aside></div><form><label>Mail</label></form><footer>&copy; x</footer>"""


def test_main_text():
    assert html_paths.extract(PAGE) == "Head & line\nFirst para, with marks.\nShort.\nitem one\nitem two"
    assert html_paths.extract(None) == html_paths.extract("") == html_paths.extract("<nav><a href=x>y</a></nav>") == ""
    assert html_paths.extract("<p>Just text.") == "Just text."
    assert html_paths.extract("<div><p>" + "Long text, here. " * 9000 + "</p></div>").count("Long") == 9000


def test_main_text_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 5)], "page_id bigint, url string, html string, text int")
    got = html_paths.main_text(df).collect()
    assert sorted((r["n_chars"], len(r["text"])) for r in got) == [(0, 0), (60, 60), (60, 60)]
    assert html_paths.main_text(df.limit(0)).count() == 0


# 2


def brute_statistics(t):
    w = WORD.findall(t or "")
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = collections.Counter(tri)
    cover = {i + k for i, g in enumerate(tri) if many[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover)


def test_base_statistics(spark, sample):
    df, rows, _ = sample
    got = outliers.quality_rules(df).collect()
    assert len(got) == len(rows)
    expected = tally((r[0], *brute_statistics(r[1])) for r in rows)
    assert tally((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == expected
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_mcd_resists_contamination():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.3, (400, 7))
    x[:120] += 8
    m, s = outliers.mcd(x)
    assert np.abs(m).max() < 0.15
    d = outliers._distances(x, m, s)
    assert d[:120].min() > outliers.chi2_quantile(1 - 1e-7, 7) > d[120:].max()


def brute_verdicts(rows):
    """kept by one MCD of each group, whatever its size."""
    s = [outliers.statistics(pa.array([r[1]])) for r in rows]
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        n, repeated = int(s[i]["n_words"][0]), int(s[i]["n_repeat_words"][0])
        if n >= 50 and 100 * repeated <= 50 * n:
            groups[r[2], r[3]].append(i)
    small = [g for g in groups if len(groups[g]) < outliers.MIN_GROUP]
    for lang in {g[0] for g in small}:
        pool = [i for g in small if g[0] == lang for i in groups[g]]
        key = (lang,) if len(pool) >= outliers.MIN_GROUP else "*"
        groups[key] = groups.get(key, []) + pool
    out = {}
    for g, own in groups.items():
        if g in small:
            continue
        x = np.concatenate([outliers.features(s[i]) for i in own])
        m, scatter = outliers.mcd(x[np.lexsort(x.T[::-1])])
        out |= {rows[i][0]: float(d) for i, d in zip(own, outliers._distances(x, m, scatter), strict=True)}
    return out


def outlier_rows(counts):
    rng, rows = np.random.default_rng(4), []
    for (lang, source), n in counts.items():
        letters, shape = list("abcdefghijklmnop"[: 6 + len(source)]), 3 + len(lang)
        for _ in range(n):
            words = ["".join(rng.choice(letters, int(rng.integers(2, shape + 4)))) + ("," if rng.random() < 0.1 else "") for _ in range(int(rng.integers(55, 90)))]
            if rng.random() < 0.04:
                words = [w + "###" for w in words]
            rows.append((len(rows), " ".join(words), lang, source))
    return rows


def test_verdicts_against_brute_force(spark):
    """Groups of one block, of several, and pooled ones."""
    rows = outlier_rows({("en", "a"): 60, ("en", "bb"): 5000, ("de", "a"): 30, ("de", "bb"): 25, ("fr", "a"): 7})
    got = {r["doc_id"]: r for r in outliers.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    expected = brute_verdicts(rows)
    cut = outliers.chi2_quantile(1 - 1e-7, 7)
    assert {i for i, r in got.items() if not r["base_failed"]} == set(expected)
    for i, d in expected.items():
        if rows[i][3] != "bb" or rows[i][2] != "en":
            assert got[i]["distance"] == pytest.approx(d, rel=1e-6)
            assert got[i]["kept"] == (d <= cut)
    large = [i for i in expected if rows[i][2:] == ("en", "bb")]
    assert sum(got[i]["kept"] == (expected[i] <= cut) for i in large) >= 0.999 * len(large)
    assert np.median([abs(got[i]["distance"] - expected[i]) / (1 + expected[i]) for i in large]) < 0.05
    junk = [i for i in expected if "###" in rows[i][1]]
    assert not any(got[i]["kept"] for i in junk) and sum(r["kept"] for r in got.values()) >= 0.99 * (len(expected) - len(junk))


def test_outliers_small_and_empty(spark, nothing):
    assert outliers.quality_rules(nothing).count() == 0
    assert abs(outliers.chi2_quantile(0.975, 7) - 16.013) < 0.1


# 3


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        free -= full
    return target


def van_der_corput(k, bits=48):
    return int(f"{k:0{bits}b}"[::-1], 2)


def test_closed_form_of_slot_ranks(spark):
    bounds = [0, 1, 1 << 47, 1 << 48, (1 << 48) // 3, 12345678901234, (1 << 48) - 1, 3 << 45]
    df = spark.range(200).select("id", *[mixing.points_below(F.col("id"), mixing.digits(F.lit(b).cast("long"))).alias(f"c{i}") for i, b in enumerate(bounds)], mixing.point(F.col("id")).alias("v"))
    for r in df.collect():
        assert r["v"] == van_der_corput(r["id"])
        for i, b in enumerate(bounds):
            assert r[f"c{i}"] == sum(van_der_corput(k) < b for k in range(r["id"]))


def test_mixing(spark, sample, nothing):
    df, rows, _ = sample
    got = mixing.mixed(df, block_words=37).collect()
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    assert tally((r["doc_id"], r["size"]) for r in got) == tally(zip([r[0] for r in rows], size, strict=True))
    own = collections.Counter()
    for r, n in zip(rows, size, strict=True):
        own[r[3]] += n
    target = brute_targets(dict(own))
    source_of = {round(t, 6): s for s, t in target.items()}
    taken = collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source_of[round(r["target"], 6)]] += r["taken"]
        assert r["source_size"] == own[source_of[round(r["target"], 6)]]
    n_slots = math.ceil(1.5 * sum(size) / 37)
    assert all(abs(taken[s] - t) <= 37 * (math.log2(n_slots) / 2 + 1) for s, t in target.items())
    edges, points = np.cumsum([0, *[target[s] for s in sorted(target, key=lambda s: (s is None, s))]]), collections.Counter()
    for k in range(n_slots):
        points[int(np.searchsorted(np.round(edges[1:-1] / (1.5 * sum(size)) * 2**48), van_der_corput(k), "right"))] += 1
    for i, s in enumerate(sorted(target, key=lambda s: (s is None, s))):
        assert taken[s] == min(37 * points[i], 2 * own[s])
    assert tally(mixing.mixed(df.repartition(7), block_words=37).collect()) == tally(got)
    assert mixing.mixed(nothing).count() == 0
    assert {r["taken"] for r in mixing.mixed(df.where("text is null")).collect()} == {0}


def test_points_decide_what_is_taken(spark, sample, monkeypatch):
    own = tally(mixing.mixed(sample[0]).collect())
    for other in (lambda k: mixing._mirrored(k * 3 + 1), lambda k: F.lit(0).cast("long")):
        monkeypatch.setattr(mixing, "point", other)
        assert tally(mixing.mixed(sample[0]).collect()) != own


def test_null_ids_are_dealt_by_text(spark):
    df = spark.createDataFrame([(None, f"text number {i}", "a") for i in range(50)], "doc_id bigint, text string, source string")
    assert mixing.mixture(df).placed.select("start").distinct().count() == 50
    assert {r["taken"] for r in mixing.mixed(df, block_words=1).collect()} <= set(range(7))


def test_schedule_follows_targets(spark, sample):
    m = mixing.mixture(sample[0], block_words=16)
    slots = m.slots.toPandas().sort_values("slot")
    assert slots["slot"].tolist() == list(range(m.n_slots))
    for _, blocks in slots.groupby("sid"):
        assert blocks["block"].tolist() == list(range(len(blocks)))
    share = slots["sid"].value_counts(normalize=True)
    half = slots.head(len(slots) // 2)["sid"].value_counts(normalize=True)
    assert (share - half).abs().max() < 0.05
    assert not slots.duplicated(["sid", "block"]).any()


# 4


def test_substrings(spark, sample, nothing):
    df, rows, _ = sample
    texts = [(r[0] if r[0] is not None else -math.inf, WORD.findall(r[1] or "")) for r in rows]
    first = {}
    for i, w in texts:
        for p in range(len(w) - 19):
            k = tuple(w[p : p + 20])
            first[k] = min(first.get(k, (math.inf, 0)), (i, p))
    expected = collections.Counter()
    for r, (i, w) in zip(rows, texts, strict=True):
        gone = {p + k for p in range(len(w) - 19) if first[tuple(w[p : p + 20])] != (i, p) for k in range(20)}
        expected[r[0], len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] += 1
    assert tally(substrings.digests(df).collect()) == expected
    assert substrings.digests(nothing).count() == 0


# 5


def brute_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(low))
        sets.append({tuple(w[p : p + 5]) for p in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), math.inf), r[0])
    return tally((r[0], len(s), r[0] if not s else least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def test_near_duplicates(spark, sample, nothing):
    df, rows, _ = sample
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert tally(got) == brute_components(rows)
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_long_lists_and_blocks(spark, monkeypatch):
    """Groups larger than a short list and than a block."""
    monkeypatch.setattr(ngram_join, "SHORT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(i % 4):
            w[(i * 7 + k * 31) % 80] = f"x{i}_{k}"
        rows.append((1000 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert tally(got) == brute_components(rows)


@pytest.mark.parametrize("block", [4, 16])
def test_documents_outside_of_the_largest_component(spark, monkeypatch, block):
    """One cluster of candidates that is several components: those of no pivot are found too."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    monkeypatch.setattr(ngram_join.Join, "_candidates", lambda self: self.sets.select(F.col("fp").alias("a"), F.lit(0).cast("long").alias("b")).unionByName(self.sets.select(F.col("fp").alias("b"), F.lit(0).cast("long").alias("a"))))
    rows = []
    for g in range(9):
        base = [f"g{g}_{i}" for i in range(70)]
        for i in range(2 + 3 * g):
            w = list(base)
            for k in range(2):
                w[(i * 11 + k * 31) % 70] = f"x{i}_{k}"
            rows.append((1000 * g + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert tally(got) == brute_components(rows)


def test_equal_sets_stand_for_each_other(spark):
    """Copies, and texts that differ in white space and case only, across partitions."""
    base = " ".join(f"w{i}" for i in range(50))
    texts = [base, base.upper(), base.replace(" ", "\n"), base + " end", base.replace("w7", "zz")] * 8 + ["alone " * 3]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    join = ngram_join.Join(df)
    assert join.texts.where("text <> ''").count() == join.sets.count() == 4
    assert tally(ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()) == brute_components(rows)


def test_lists_dealt_over_buckets():
    class Often:
        def __call__(self, keys):
            return np.full(len(keys), 8 * 18, np.uint8)

    base = [f"w{i}" for i in range(30)]
    texts = [" ".join([*base, f"x{i}"]) for i in range(400)]
    out = list(ngram_join._emit_prefixes(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]), Often(), 10))
    rows = [(b, n, d) for batch in out for b, n, d in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "data")), strict=True)]
    by = collections.defaultdict(list)
    for b, n, d in rows:
        by[b].append((n, d))
    lists = pd.concat([ngram_join._lists((b,), pd.DataFrame(v, columns=["n", "data"])) for b, v in by.items()])
    assert (lists["size"] > ngram_join.SHORT).all() and (lists["l"] < ngram_join.MARK).all()
    assert lists.groupby("t")["fp"].nunique().max() == 400  # no member is lost


def test_prefixes_share_enough():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, edits = int(rng.integers(5, 60)), int(rng.integers(0, 4))
        x = np.sort(rng.choice(1 << 40, n, replace=False).astype(np.uint64))
        y = np.sort(np.concatenate([x[edits:], rng.choice(1 << 40, edits, replace=False).astype(np.uint64)]))
        y = np.unique(y)
        inter = len(np.intersect1d(x, y))
        if 100 * inter < 80 * (len(x) + len(y) - inter):
            continue
        value, first = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
        codes = (value % np.uint64(97)).astype(np.uint8)
        at, doc, shared = ngram_join.prefixes(value, first, codes, np.array([0, 1]))
        common = len(np.intersect1d(value[at[doc == 0]], value[at[doc == 1]]))
        assert common >= min(shared)


# 6


def test_lengths(spark, sample, nothing):
    df, rows, _ = sample
    encode = lengths.encoder(open(lengths.VOCABULARY, "rb").read(), lengths.PATTERN).encode_ordinary
    n = sorted(len(encode(r[1] or "")) for r in rows)
    got = lengths.length_histogram(lengths.token_lengths(df)).orderBy("n_tokens").collect()
    assert {r["n_tokens"]: r["n_docs"] for r in got} == collections.Counter(n)
    for r in got:
        assert r["tokens_kept"] == sum(min(x, r["n_tokens"]) for x in n) and r["tokens_total"] == sum(n)
        assert r["docs_over"] == sum(x > r["n_tokens"] for x in n)
    h = lengths.length_histogram(lengths.token_lengths(df))
    assert lengths.quantile(h, 0.5).first()[0] == n[math.ceil(0.5 * len(n)) - 1]
    assert lengths.truncated_total(h, 100).first()[0] == sum(min(x, 100) for x in n)
    assert lengths.length_histogram(lengths.token_lengths(nothing)).count() == 0


# 7


def test_hilbert_curve_is_a_path(spark):
    bits, n = 3, 3
    cells = spark.range(1 << (bits * n)).select(*[F.shiftright("id", bits * i).bitwiseAND(F.lit(7)).alias(f"a{i}") for i in range(n)])
    got = cells.withColumn("h", hilbert.hilbert_index([F.col(f"a{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r["h"] for r in got] == list(range(512))
    assert all(sum(abs(a[f"a{i}"] - b[f"a{i}"]) for i in range(n)) == 1 for a, b in zip(got, got[1:], strict=False))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_sharding(spark, sample, nothing, law):
    df, rows, _ = sample
    got = hilbert.shards(df, 7, law).collect()
    expected = tally((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert tally((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append((r["slot"], r["curve"], r["size"]))
    for held in by.values():
        held.sort()
        assert [s for s, _, _ in held] == list(range(len(held)))
        assert [c for _, c, _ in held] == sorted(c for _, c, _ in held)
    if law == "rows":
        sizes = [len(by[k]) for k in range(7)]
        assert max(sizes) - min(sizes) <= 1
    else:
        total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
        assert all(abs(sum(x[2] for x in held) - total / 7) <= most for held in by.values())
    assert hilbert.shards(nothing, 7, law).count() == 0


def test_sharding_renames_clashing_columns(spark, sample):
    df, rows, _ = sample
    out = hilbert.sharded(df, 5)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "input_size", "input_shard", "key", "size", "shard", "slot", "curve"]
    assert tally(out.select("doc_id", "text", "lang", "source", "n_chars", "extra", "input_size", "input_shard", "key").collect()) == tally(rows)


def test_partitions_split_a_hot_cell(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    for rows in (df, df.withColumn("doc_id", F.lit(None).cast("bigint")).withColumn("text", F.concat("text", F.rand(3).cast("string")))):
        sizes = [r["count"] for r in hilbert.shards(rows, 4, partitions=8).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6000 and max(sizes) < 2000


def test_write_shards(spark, sample, tmp_path):
    hilbert.write_shards(sample[0], f"file://{tmp_path}/out", 4)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert back.count() == len(sample[1]) and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


# 8


def test_leaks(spark, sample, nothing):
    df, rows, passage = sample
    w = passage.split(" ")
    items = spark.createDataFrame([(1, passage), (2, " ".join(w[:20])), (3, None), (4, ""), (5, "two words"), (6, "not anywhere in the corpus at all"), (7, " ".join(w[:59] + ["zz"])), (8, " ".join(w[:30] + ["zz"] + w[31:]))], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(df, items).collect()}
    holders = {r[0] for r in rows if passage in (r[1] or "")}
    assert got == {(d, i) for d in holders for i in (1, 2, 7, 8)} | {(r[0], 5) for r in rows if "two words" in (r[1] or "")}
    kept = decontamination.without_leaks(df, items)
    assert kept.columns == df.columns and kept.count() == len(rows) - len(holders) - 1
    assert decontamination.leaks(nothing, items).count() == 0 and decontamination.leaks(df, items.limit(0)).count() == 0


def test_blocks_find_all_within_the_radius(spark):
    """Every pair of fingerprints within the radius meets, once per block that is near enough, and few others do."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        x = rng.random(64) < 0.5
        y = x.copy()
        n = int(rng.integers(0, decontamination.RADIUS + 1)) if i < 300 else int(rng.integers(0, 64))
        y[rng.choice(64, n, replace=False)] ^= True
        rows.append((i, *[int(np.packbits(v, bitorder="little").view("<i8")[0]) for v in (x, y)]))
    df = spark.createDataFrame(rows, "id bigint, x bigint, y bigint")
    masks = decontamination.flips(spark)
    assert masks.count() == sum(1 + w + w * (w - 1) // 2 for w in decontamination.WIDTHS)
    x = decontamination.flipped(df.select("id", F.col("x").alias("simhash")), masks, "mx").drop("simhash")
    y = decontamination.flipped(df.select("id", F.col("y").alias("simhash")), masks, "my").drop("simhash")
    met = x.join(y, ["id", "block", "value"]).where(decontamination.once(F.col("mx"), F.col("my"))).groupBy("id").count().collect()
    got = {r["id"]: r["count"] for r in met}
    assert sum(w for w in decontamination.WIDTHS) == 64 and len(decontamination.WIDTHS) * (2 * decontamination.FLIPS + 1) > decontamination.RADIUS
    for i, a, b in rows:
        d, at, expected = (a ^ b) % (1 << 64), 0, 0
        for w in decontamination.WIDTHS:
            expected += (d >> at & ((1 << w) - 1)).bit_count() <= 2 * decontamination.FLIPS
            at += w
        assert got.get(i, 0) == expected and (expected or d.bit_count() > decontamination.RADIUS)
    chance = sum(sum(math.comb(w, k) for k in range(2 * decontamination.FLIPS + 1)) / 2**w for w in decontamination.WIDTHS)
    assert chance < 0.01


def weighted(a, b):
    x, y = (collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    low = sum((x & y).values())
    return low, sum(x.values()) + sum(y.values()) - low


def test_recall_against_brute_force_over_all_windows(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: rng.choice(vocabulary, n).tolist()
    items = [(i, some(int(rng.integers(25, 80)))) for i in range(60)]
    docs = []
    for i in range(240):
        own = list(items[i % 60][1])
        for _ in range(int(rng.integers(0, 3))):
            own[int(rng.choice([0, 1, 2, 3, len(own) - 1, len(own) - 2, int(rng.integers(0, len(own)))]))] = "zz"
        docs.append((i, some(int(rng.integers(0, 60))) + own + some(int(rng.integers(0, 60)))))
    expected, border = set(), set()
    for d, w in docs:
        for i, own in items:
            if len(set(w) & set(own)) < 10:
                continue
            m = len(own)
            for at in range(-m + 5, len(w) - 4):
                low, high = weighted(w[max(at, 0) : min(at + m, len(w))], own)
                if 100 * low >= 80 * high:
                    expected.add((d, i))
                    border |= {(d, i)} if 100 * low < 90 * high else set()
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(
        spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    ).collect()}
    assert got <= expected and len(expected) > 150 and len(border) > 30
    assert len(got) >= 0.95 * len(expected) and len(got & border) >= 0.9 * len(border)


# 9


@pytest.mark.parametrize("least", [1, 2, 3])
def test_lines(spark, sample, nothing, least):
    df, rows, _ = sample
    sites = collections.defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if WORD.search(line):
                sites[line.strip(" ")].add(r[3])
    expected = collections.Counter()
    for r in rows:
        own = (r[1] or "").split("\n")
        kept = [x for x in own if not (WORD.search(x) and len(sites[x.strip(" ")]) >= least)]
        expected[r[0], len(own) if r[1] is not None else 0, len(own) - len(kept), "\n".join(kept) if r[1] is not None else None] += 1
    assert tally(lines.without_boilerplate(df, least).collect()) == expected
    assert lines.without_boilerplate(nothing).count() == 0


# 10


def test_classifier_learns_and_scores(spark):
    good, bad = "the quick reader of old books and letters ", "b&&&uy n%%%ow ch$$$eap ###deal *** "
    rows = [(i, (good if i % 3 else bad) * (1 + i % 5) + str(i)) for i in range(240)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, good)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in subword.classified(docs, labels).collect()}
    assert len(got) == 243 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert all(got[i]["predicted"] == int(i % 3 > 0) for i, _ in rows)
    assert got[900]["score"] == got[901]["score"]
    assert {r["score"] for r in subword.classified(docs, labels.limit(0)).collect()} == {0.5}
    assert subword.classified(docs.limit(0), labels).count() == 0


def test_ranking_of_held_out_labels(spark):
    """Area under the curve on the labelled rows that training never saw."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = subword.classified(docs, labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    good, bad = got[got["quality"] == 1]["score"].to_numpy(), got[got["quality"] == 0]["score"].to_numpy()
    assert len(good) > 50 and len(bad) > 5
    assert ((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean() >= 0.95


def test_score_is_the_softmax_of_the_average():
    m = subword.fit(["good words here"] * 5 + ["### bad"] * 5, [1] * 5 + [0] * 5)
    texts = ["good bad ### words words", "x", "", "ü漢 good " * 50]
    for t, s in zip(texts, m.score(pa.array(texts)), strict=True):
        found, share = subword.features(t)
        assert abs(s - 1 / (1 + math.exp(-(float(share @ m.weights[found]) + m.bias)))) < 1e-5
    assert m.score(pa.array(texts))[3] == pytest.approx(m.score(pa.array([texts[3]]))[0], abs=1e-8)
