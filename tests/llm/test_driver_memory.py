"""What the pipeline's stages hold in the driver."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import decontamination, store, subword


def sample_texts(n, length):
    rng = random.Random(8)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ,.") for _ in range(length)) for _ in range(n)]


def test_training_holds_few_features():
    """About 8 kB of buckets and shares a kB of text, kept for all texts, is more than the vectors."""
    texts = sample_texts(800, 3000)
    subword.fit(texts[:9], [1, 0] * 4 + [1])
    tracemalloc.start()
    subword.fit(texts, [i % 2 for i in range(len(texts))], epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6


@pytest.mark.parametrize("text", ["", " \n", "one", "Ünï códe ß 漢字 " * 30, "word " * 70_000, "x" * 3000, *sample_texts(3, 900)])
def test_packed_features(text):
    want, got = subword.features(text), subword.unpacked(*subword.packed(text))
    assert [a.dtype for a in got] == [np.int32, np.float32]
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_narrow_blocks_find_all_within_the_radius(spark):
    """Every pair of fingerprints within the radius meets, once per block that is near enough."""
    widths, up_to = decontamination.FEW_WIDTHS, decontamination.FEW_FLIPS
    assert sum(widths) == 64 and len(widths) * (2 * up_to + 1) > decontamination.RADIUS
    assert len(widths) <= 1 << decontamination.BLOCK_BITS and max(widths) <= decontamination.VALUE_BITS
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = rng.random(64) < 0.5
        y = x.copy()
        y[rng.choice(64, int(rng.integers(0, decontamination.RADIUS + 1 if i < 300 else 64)), replace=False)] ^= True
        rows.append((i, *[int(np.packbits(v, bitorder="little").view("<i8")[0]) for v in (x, y)]))
    df = spark.createDataFrame(rows, "id bigint, x bigint, y bigint")
    masks = decontamination.flips(spark, widths, up_to)
    assert masks.count() == decontamination.rows_flipped(widths, up_to) == 69
    x = decontamination.flipped(df.select("id", F.col("x").alias("simhash")), masks, "mx", widths).drop("simhash")
    y = decontamination.flipped(df.select("id", F.col("y").alias("simhash")), masks, "my", widths).drop("simhash")
    met = x.join(y, ["id", "block", "value"]).where(decontamination.once(F.col("mx"), F.col("my"))).groupBy("id").count().collect()
    got = {r["id"]: r["count"] for r in met}
    for i, a, b in rows:
        d, at, expected = (a ^ b) % (1 << 64), 0, 0
        for w in widths:
            expected += (d >> at & ((1 << w) - 1)).bit_count() <= 2 * up_to
            at += w
        assert got.get(i, 0) == expected and (expected or d.bit_count() > decontamination.RADIUS)


def test_few_items_make_a_small_table(spark, monkeypatch):
    """The driver builds the table of flipped items; wide blocks and exchanged items find the same."""
    sent = []
    broadcast = decontamination.F.broadcast
    monkeypatch.setattr(decontamination.F, "broadcast", lambda df: sent.append(df.count() if "item_mask" in df.columns else 0) or broadcast(df))
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passages = [words(n) for n in (3, 5, 30, 40, 60, 60)]
    texts = []
    for i in range(60):
        w = list(passages[i % len(passages)])
        for k in range(i // 12):
            w[rng.randrange(len(w))] = f"x{k}"
        texts.append((i, " ".join(words(20) + w + words(9))))
    docs = spark.createDataFrame([*texts, (None, texts[2][1]), (90, None), (91, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(passages)], "item_id bigint, text string")
    found = lambda: sorted(map(tuple, decontamination.leaks(docs, items).collect()), key=str)
    few = found()
    assert len(few) > 15 and sum(sent) == 69 * len(passages)
    monkeypatch.setattr(decontamination, "FEW_ITEMS", 0)
    assert found() == few
    monkeypatch.setattr(decontamination, "BROADCAST_FLIPPED", 0)
    sent.clear()
    assert found() == few and not sum(sent)
    store.release()
