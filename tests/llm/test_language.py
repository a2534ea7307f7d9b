import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from optionflow.llm import language
from optionflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"), ~language.held_out(F.col("doc_id")))


def test_held_out_accuracy(spark):
    got = QUERIES["op7_language_spans"](spark, SF)
    right = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    share = right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert share[0] > 0.97 and share[1] > 200
    assert got.filter("score < 0 or score > 1").count() == 0


def test_mixed_text_is_cut_where_languages_meet(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 600 and text not like '%|%'")
    one = {r.lang: r.text.split()[:80] for r in docs.dropDuplicates(["lang"]).collect()}
    text = " ".join(one["fr"] + one["en"])
    langs, shares, spans, _ = language.label(language.Scorer(model), [text.encode()])
    parts = [s.split(":") for s in spans[0].split(",")]
    assert [p[0] for p in parts] == ["fr", "en"] and abs(int(parts[0][2]) - 80) <= 3
    assert 0.4 < shares[0] < 0.6 and langs[0] in ("fr", "en")


def test_odd_rows(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 34 !? ² ½ _", "x"), (4, "the " * 50_000, None), (4, "the " * 50_000, None), (None, "Und der die das", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language.predict(df, model, keep=["doc_id", "lang"]).collect()
    assert [(r.doc_id, r.lang) for r in got] == [(a, c) for a, _, c in rows]
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and {r.lang_score for r in got[:3]} == {0.0}
    assert got[3].lang_pred == "en" and got[3] == got[4] and got[5].lang_pred == "de"
    assert language.predict(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        language.predict(df.withColumn("lang_pred", F.lit("x")), model)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    none = language.fit(docs, F.lit(True))
    assert [r.lang_pred for r in language.predict(docs, none).collect()] == ["und", "und"]


def test_scripts_narrow_the_candidates(spark):
    rows = [(1, "привет мир как дела", "ru"), (2, "hello world how are you", "en"), (3, "hola mundo como estas", "es")]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    assert model.languages == ("en", "es", "ru")
    assert model.scripts["Cyrillic"].tolist() == [False, False, True]
    assert language.label(language.Scorer(model), ["неизвестное слово".encode()])[0] == ["ru"]


def plain_viterbi(scores, switch):
    best, came = scores[0], []
    for row in scores[1:]:
        step = best[None, :] - switch * (1 - np.eye(len(best)))
        came.append(step.argmax(1))
        best = step.max(1) + row
    label = [int(best.argmax())]
    for back in reversed(came):
        label.append(int(back[label[-1]]))
    return best.max(), label[::-1]


def test_viterbi_over_many_texts_equals_one_by_one():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 1, 7, 30, 0, 12, 30, 2])
    scores = rng.normal(size=(lengths.sum(), 3)) * 3
    labels = language.viterbi(scores, lengths, 2.5)
    first = 0
    for n in lengths:
        if n:
            mine, path = scores[first : first + n], labels[first : first + n]
            value, _ = plain_viterbi(mine, 2.5)
            got = mine[np.arange(n), path].sum() - 2.5 * (np.diff(path) != 0).sum()
            assert abs(got - value) < 1e-9
        first += n


def test_portions_bound_the_work_and_lose_nothing():
    from optionflow.llm.texts import portions

    column = pa.array([b"x" * 10, None, b"", b"y" * 1000] * 100, pa.binary())
    parts = list(portions(column, 2000))
    assert [t for p in parts for t in p] == [c or b"" for c in column.to_pylist()] and len(parts) > 5


def brute_word(model, word):
    """Scores of a word gram by gram, its letters, and of how many the 3-gram is known."""
    index = {int(g): i for i, g in enumerate(model.grams)}
    runs = language.LETTERS.findall(word)
    total, letters, seen = np.zeros(len(model.languages)), 0, 0
    for run in runs:
        framed = f"_{run}_"
        grams = list(run) + [framed[i : i + 2] for i in range(len(run) + 1)] + [framed[i : i + 3] for i in range(len(run))]
        for g in grams:
            i = index.get(language.code(g))
            total += (model.unseen if i is None else model.scores[i]) / 3
            seen += i is not None and len(g) == 3
        letters += len(run)
    if not runs:
        return total, 0, 0
    fits = model.scripts.get(language.script(runs[0][0]))
    if fits is not None and fits.any() and not fits.all():
        total = np.where(fits, total, total.min() - language.MOST)
    return np.maximum(total - total.max(), -language.MOST), letters, seen


def brute_label(model, text):
    words = text.lower().split()
    scored = [brute_word(model, w) for w in words]
    if not any(n for _, n, _ in scored):
        return "und", 0.0, 0.0
    k = len(model.languages)
    value, back = np.float32(scored[0][0]), []
    for s, _, _ in scored[1:]:
        best = int(value.argmax())
        stay = value >= value[best] - language.SWITCH
        back.append([j if stay[j] else best for j in range(k)])
        value = np.maximum(value, value[best] - language.SWITCH) + np.float32(s)
    path = [int(value.argmax())]
    for step in reversed(back):
        path.append(step[path[-1]])
    path = path[::-1]
    mine = [p for p, (_, n, _) in zip(path, scored) if n]
    counts = np.bincount(mine, minlength=k)
    return model.languages[int(counts.argmax())], counts.max() / len(mine), sum(x for *_, x in scored) / sum(n for _, n, _ in scored)


def test_labels_equal_brute_force(spark, model):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    texts += ["the le der la " * 12, "привет the мир", "12 a_b c-d É", "x" * 300]
    langs, shares, _, known = language.label(language.Scorer(model), [t.encode() for t in texts])
    for t, l, s, k in zip(texts, langs, shares, known):
        want = brute_label(model, t)
        assert (l, s) == want[:2] and abs(k - want[2]) < 1e-12, t[:50]


def test_model_equals_counting(spark):
    from collections import Counter

    docs = [(r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text and r.lang]
    model = language.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), F.lit(True), sample=10**9)
    counts = {l: Counter() for l in sorted({l for _, l in docs})}
    for text, l in docs:
        for run in language.LETTERS.findall(text.lower()):
            framed = f"_{run}_"
            counts[l].update([*run, *(framed[i : i + 2] for i in range(len(run) + 1)), *(framed[i : i + 3] for i in range(len(run)))])
    assert model.languages == tuple(counts) and all(len(c) < language.GRAMS for c in counts.values())
    grams = sorted({g for c in counts.values() for g in c}, key=language.code)
    assert model.grams.tolist() == [language.code(g) for g in grams]
    for j, c in enumerate(counts.values()):
        total = [0, *(sum(n for g, n in c.items() if len(g) == k) for k in (1, 2, 3))]
        want = [np.log(c[g] + 1) - np.log(total[len(g)] + len(grams)) for g in grams]
        assert np.allclose(model.scores[:, j], want)


def test_very_long_texts_and_small_steps(spark, model, monkeypatch):
    rows = [(i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect())]
    rows.append((99, "the and of " * 200_000))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(tuple(r) for r in language.predict(df, model, keep=["doc_id"]).collect())
    monkeypatch.setattr(language, "STEP_BYTES", 1000)
    monkeypatch.setattr(language, "REMEMBERED", 5000)
    assert sorted(tuple(r) for r in language.predict(df, model, keep=["doc_id"]).collect()) == want
    whole = language.predict(df, model).drop("text")
    assert sorted(tuple(r) for r in whole.collect()) == want
