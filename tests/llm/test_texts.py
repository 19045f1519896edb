import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import encoding, leakage, mixing


def _shares(a, b, n):
    grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
    return any(tuple(a[i : i + n]) in grams for i in range(len(a) - n + 1))


def test_fingerprints_are_the_window_minimums():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 40))) for _ in range(100)] + [None, ""]
    _, which, word = leakage.fingerprint_rows(texts, 3, 4)
    got = {}
    for t, w in zip(which, word):
        got.setdefault(int(t), set()).add(int(w))
    for i, t in enumerate(texts):
        h, _, _ = leakage._hashes([t], 3)
        want = set()
        for s in range(max(len(h) - 3, min(len(h), 1))):
            part = h[s : s + 4]
            want.add(s + int(np.flatnonzero(part == part.min())[-1]))
        assert got.get(i, set()) == want


def test_every_shared_run_is_found(spark):
    rng = random.Random(2)
    lexicon = [f"w{i}" for i in range(30)] + ["Ünï", "x_y", "naïve-café"]
    items = [" ".join(rng.choice(lexicon) for _ in range(40)) for _ in range(12)]
    docs = []
    for i in range(150):
        body = [rng.choice(lexicon) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.6:
            source, n = rng.choice(items).split(), rng.randint(6, 20)
            at = rng.randint(0, len(source) - n)
            body[rng.randint(0, len(body)) :] = [w.upper() for w in source[at : at + n]] + body[:5]
        docs.append((i, ", ".join(body)))
    docs += [(900, None), (901, ""), (902, "word " * 50_000 + items[0]), (None, items[0])]
    d = spark.createDataFrame(docs, "id long, t string").withColumns({"item": F.lit(1), "_h": F.lit(2), "doc_at": F.lit(3)})
    t = spark.createDataFrame([*enumerate(items), (0, items[0]), (99, None), (98, "too short")], "no long, t string")
    got = {(r.doc, r.item): (r.shared_words, r.doc_word) for r in leakage.leaks(d, "id", "t", t, "no", "t").collect()}
    split = {i: leakage.words(x) for i, x in docs if i is not None}
    assert set(got) == {(i, j) for i, a in split.items() for j, x in enumerate(items) if _shares(a, leakage.words(x), 12)}
    assert got[902, 0] == (len(leakage.words(items[0])), 50_000)
    for (i, j), (n, at) in got.items():
        b = leakage.words(items[j])
        run = split[i][at : at + n]
        assert len(run) == n >= 12 and any(b[s : s + n] == run for s in range(len(b))) and not _shares(split[i], b, n + 1)


def test_leaks_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "id long, t string")
    assert leakage.leaks(d.limit(0), "id", "t", d, "id", "t").count() == 0
    assert leakage.leaks(d, "id", "t", d.limit(0), "id", "t").count() == 0
    with pytest.raises(ValueError):
        leakage.leaks(d, "id", "t", d, "id", "t", min_words=5, gram=8)


_TARGETS = [("a", 0.5, 1), (" B ", 0.3, 3), ("c", 0.2, 2), ("gone", 0.1, 4), (None, 0.1, 1)]


def _sized(spark):
    rng = random.Random(3)
    rows = [(i, "A " if i % 2 else "a", rng.randint(1, 9)) for i in range(600)] + [(1000 + i, "b", 5) for i in range(40)]
    rows += [(2000 + i, "C", rng.randint(1, 9)) for i in range(300)] + [(3000, None, 50), (3001, "other", 70), (3002, "c", 0), (3003, "NA", 5)]
    return rows, spark.createDataFrame(rows, "id long, source string, size long").withColumn("target_share", F.lit(9.0))


def test_mixture(spark):
    rows, df = _sized(spark)
    targets = spark.createDataFrame(_TARGETS, "source string, target_share double, max_repeats int")
    total = sum(r[2] for r in rows)
    mixed = mixing.mix_order(df, "id", "source", targets).collect()
    ordered = sorted(mixed, key=lambda r: r.upto)
    assert [r.finish for r in ordered] == sorted(r.finish for r in ordered)
    assert ordered[-1].upto == sum(r.size for r in ordered) <= total
    seen = {}
    for r in ordered:
        seen.setdefault((r.source, r.key), []).append(r.pass_no)
    caps = {"a": 1, "b": 3, "c": 2}
    assert all(p == list(range(len(p))) and len(p) <= caps[s] for (s, _), p in seen.items())
    assert not {r.key for r in mixed} & {3000, 3001, 3002, 3003}
    # At any point a source that has something left is less than a document behind its share.
    for t in (100, 300, 700):
        for s, share in (("a", 0.5), ("c", 0.2)):
            assert 0 <= share * t - sum(r.size for r in ordered if r.source == s and r.finish <= t) < 9
    report = {r.source: r for r in mixing.mix_report(df, "id", "source", targets).collect()}
    assert {s for s, r in report.items() if r.falls_short} == {s for s, share, cap in (("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("gone", 0.1, 4)) if sum(x[2] for x in rows if (x[1] or "").strip().lower() == s) * cap < share * total}
    assert report["b"].passes == 3 and report["gone"].mixed == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9


def test_mixture_is_the_same_for_any_partitions(spark):
    _, df = _sized(spark)
    targets = spark.createDataFrame(_TARGETS, "source string, target_share double, max_repeats int")
    outs = [sorted((r.key, r.pass_no, r.upto) for r in mixing.mix_order(d, "id", "source", targets, budget=900).collect()) for d in (df, df.repartition(7))]
    assert outs[0] == outs[1]


def test_mixture_of_nothing(spark):
    targets = spark.createDataFrame(_TARGETS, "source string, target_share double, max_repeats int")
    empty = spark.createDataFrame([], "id long, source string, size long")
    assert mixing.mix_order(empty, "id", "source", targets).count() == 0
    assert {r.mixed for r in mixing.mix_report(empty, "id", "source", targets).collect()} == {0}


def test_sizes(spark):
    df = spark.createDataFrame([("a  b\tc\nd e",), ("",), (None,), (" x ",)], "t string")
    assert [r.n for r in df.select(mixing.word_count(F.col("t")).alias("n")).collect()] == [5, 0, 0, 1]
    sizes = [r["size"] for r in mixing.token_sizes(df.withColumn("size", F.lit("old")), "t").collect()]
    assert sizes[1:3] == [0, 0] and sizes[0] >= 5


_CLEAN = [
    "Der Wasserkocher läuft während des Umzugs völlig ohne Störung.", "Très déçu, à éviter à tout prix, même après l’été.", "Está en el salón, detrás de la mesa pequeña.",
    "Não há o que reclamar da almofada, é ótimo.", "Доставили за семь дней, упаковано очень удобно.", "It’s worth the €188 I paid — “really”.", "Всё сделано тихо и надёжно, цена оправдала.",
    "Funciona à perfeição já no primeiro dia.", "Früher gab es nichts, was so schön wäre.", "Je l’ai posé près de l’entrée, à côté.",
]


@pytest.mark.parametrize("label", encoding.LABELS[1:])
def test_chains_can_be_undone(label):
    made = [(t, encoding.garble(t, label)) for t in _CLEAN]
    done = [(t, g) for t, g in made if g]
    assert done
    if label in encoding.CHAINS:
        assert all(encoding.ungarble(g, label) == t for t, g in done)
    elif label in encoding.LOST:
        assert all(encoding.LOST_MARK in g and encoding.ungarble(g, label) is None for _, g in done)
    else:
        back = [(t, encoding.ungarble(g, label)) for t, g in done]
        assert sum(b == t.lower() or (b or "").lower() == t.lower() for t, b in back) >= len(back) // 2


def _corpus(spark):
    """Sentences of the documents, the clean ones as far as the classifier is concerned."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return rows


def test_held_out_accuracy(spark):
    docs = _corpus(spark)
    model = encoding.train(docs.filter("doc_id % 2 = 0"), "text")
    held = [r.text for r in docs.filter("doc_id % 2 = 1").collect()]
    units = [u for t in held for u in [t] if not u.isascii()]
    clean = [t for t, s in zip(units, model.scores(units)) if s.argmax() == 0][:600]
    assert len(clean) > 500
    right = total = 0
    for label in encoding.CHAINS:
        made = [g for g in (encoding.garble(t, label) for t in clean) if g]
        for g, s in zip(made, model.scores(made)):
            name = encoding.LABELS[int(s.argmax())]
            total += 1
            right += encoding.ungarble(g, name) == encoding.ungarble(g, label)
    assert right / total > 0.97
    made = [(t, g) for t in clean[:200] for g in [encoding.garble(t, "utf8>cp1252")] if g]
    fixed = [out == t for (t, _), (out, _, _) in zip(made, encoding._repair_all([g for _, g in made], model, 4.0))]
    assert sum(fixed) / len(fixed) > 0.97


def test_repair_of_odd_rows(spark):
    model = encoding.train(_corpus(spark), "text", rows=5000)
    bad = encoding.garble("Très déçu, à éviter.", "utf8>cp1252")
    part = "Die Küche ist schön. " + encoding.garble("Früher war es für Größe 5 völlig gemütlich.", "utf8>latin1") + " Grüße aus Köln."
    rows = [(1, bad), (2, None), (3, ""), (4, "plain"), (5, "Très déçu, à éviter."), (1, bad), (6, part), (7, "caf� d�j� vu"), (8, (bad + " ") * 3000)]
    df = spark.createDataFrame(rows, "id long, t string").withColumns({"key": F.lit(1), "unit": F.lit("é")})
    out = sorted(((r.key, r.restored, r.complete) for r in encoding.repair_encoding(df, "id", "t", model).collect()), key=lambda x: x[0])
    assert [x[0] for x in out] == [1, 1, 6, 7, 8]
    assert out[0][1] == "Très déçu, à éviter." and out[2][1] == "Die Küche ist schön. Früher war es für Größe 5 völlig gemütlich. Grüße aus Köln."
    assert out[3][1:] == (None, False) and out[4][1] == "Très déçu, à éviter. " * 3000
    empty = df.limit(0)
    assert encoding.repair_encoding(empty, "id", "t", encoding.train(empty, "t")).count() == 0


@pytest.mark.parametrize("label", encoding.CHAINS)
def test_chains_can_be_undone_through_references(label):
    done = [(t, encoding.escape(g)) for t in _CLEAN for g in [encoding.garble(t, label)] if g]
    assert done and all(g.isascii() and encoding.ungarble(g, label) == t for t, g in done)


def test_references(spark):
    assert encoding.unescape("&#195;&#xA9;&Atilde;&#0233;") == "\xc3\xa9\xc3\xe9"
    for kept in ("a & b; &#38;&#x27;&amp;&lt;&none;&#;&#x;", "&#55296;&#1114112;&#99999999999;", "&#" + "9" * 10_000 + ";"):
        assert encoding.unescape(kept) == kept
    assert all(encoding.unescape(encoding.escape(t)) == t for t in _CLEAN)

    model = encoding.train(_corpus(spark), "text", rows=5000)
    rows = [
        (1, "She said she didn&#226;&#8364;&#8482;t want it."), (2, "Je l&#226;&#8364;&#8482;ai posé près de là."), (3, "Caf&#233; d&#xe9;j&agrave; vu &amp; more. It&#8217;s fine."),
        (4, "A &#38; B &#39;x&#39;"), (5, "Muito &Atilde;&ordm;til. At&#xC3;&#xA9; caf&#233;."), (6, encoding.escape(encoding.garble("Très déçu, à éviter.", "utf8>latin1"))),
    ]
    out = {r.key: r for r in encoding.repair_encoding(spark.createDataFrame(rows, "id long, t string"), "id", "t", model).collect()}
    assert {k: r.restored for k, r in out.items()} == {
        1: "She said she didn’t want it.", 2: "Je l’ai posé près de là.", 5: "Muito útil. Até caf&#233;.", 6: "Très déçu, à éviter.",
    }
    assert all(r.complete and r.chains.endswith(encoding.REFERENCES) for r in out.values())


def test_documents_garbled_as_references_are_found(spark):
    docs = _corpus(spark)
    model = encoding.train(docs, "text")
    out = encoding.repair_encoding(docs.filter("doc_id IN (6167, 7361, 8530)"), "doc_id", "text", model).collect()
    assert {r.key for r in out} == {6167, 7361, 8530} and not any("&#" in r.restored for r in out)


def test_words_that_look_odd_when_restored(spark):
    model = encoding.train(_corpus(spark), "text")
    clean = "NÃO RECOMENDO, A DEVOLUÇÃO É UMA CONFUSÃO. ATENÇÃO À MEDIÇÃO."
    rows = [("clean", clean)] + [(label, encoding.garble(clean, label)) for label in ("utf8>latin1", "utf8>cp1252", "utf8>latin1 twice", "utf8>cp1252 twice")]
    out = {r.key: r.restored for r in encoding.repair_encoding(spark.createDataFrame(rows, "id string, t string"), "id", "t", model).collect()}
    assert out == {label: clean for label, _ in rows[1:]}
