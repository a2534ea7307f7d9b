from collections import Counter

import corpus_pipeline as pipeline
import pytest
from optionflow.llm import language, secrets
from optionflow.llm.store import kept

from .test_ngram_join import brute
from .test_packing import ids_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [
        (9001, None, None, "src1", 0), (9002, "", "en", None, 0), (9003, "1234 5678 !!", "en", "src2", 12),
        (9004, "the and of " * 40 + "token=abcdefgh12", None, None, None), (9005, "the  AND of " * 40 + "token=abcdefgh12", "en", "src1", 5),
        (None, "the and of on at " + "is it was for " * 30, "en", "src3", 3), (9005, "the  AND of " * 40 + "token=abcdefgh12", "en", "src1", 5),
    ]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    tables = [docs]
    for _, stage in pipeline.STAGES:
        tables.append(kept(stage(spark, tables[-1], SF)))
    return tables


def test_columns_of_documents_stay(stages):
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mixture", "packing"]
    for table in stages[1:-1]:
        assert table.columns == stages[0].columns and table.dtypes == stages[0].dtypes


def test_language_stage_rejects_only_texts_without_language(stages, spark):
    before, after = stages[0].collect(), stages[1].collect()
    lost = Counter(r.doc_id for r in before) - Counter(r.doc_id for r in after)
    assert lost == {9001: 1, 9002: 1, 9003: 1}
    assert next(r.lang for r in after if r.doc_id == 9004) == "en"
    model = language.fit(stages[0], language.F.lit(True))
    langs, shares, _, known = language.label(language.Scorer(model), [(r.text or "").encode() for r in before])
    stays = [r.doc_id for r, l, s, k in zip(before, langs, shares, known) if l != "und" and s >= pipeline.LEAST_SHARE and k >= pipeline.LEAST_KNOWN]
    assert Counter(stays) == Counter(r.doc_id for r in after)


def test_language_stage_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9101, "ნახვამდის მეგობარო " * 30), (9102, "xq zzkwq vvjx qqx wxzk jqv " * 30), (9103, "नमस्ते दुनिया " * 40), (9104, "the and of " * 20)]
    more = spark.createDataFrame([(i, t, None, "src1", 1) for i, t in odd], docs.schema)
    before = docs.unionByName(more)
    after = {r.doc_id for r in pipeline.language_stage(spark, before, SF).collect()}
    assert after & {i for i, _ in odd} == {9104}
    assert {r.doc_id for r in docs.collect()} <= after


def test_very_long_text_and_clashing_names_go_through(spark):
    rows = [(1, "the and of " * 300_000, "en", "src1", 1, "a"), (2, "of the and it " * 9, "en", "src2", 1, "b"), (3, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, body string")
    for name, stage in pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "body"], name
    with pytest.raises(ValueError, match="lang_pred"):
        pipeline.language_stage(spark, docs.withColumnRenamed("body", "Lang_Pred"), SF)
    with pytest.raises(ValueError, match="spans"):
        pipeline.secret_stage(spark, docs.withColumnRenamed("body", "spans"), SF)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    groups = {c for _, _, c in brute(rows, pipeline.NEAR_WORDS, pipeline.NEAR_PERCENT)}
    got = [r.doc_id for r in stages[2].collect()]
    assert Counter(got) == Counter(groups)


def test_secrets_are_gone_and_documents_stay(stages):
    before, after = ({r.doc_id: r for r in t.collect()} for t in stages[2:4])
    assert set(before) == set(after)
    for id, r in before.items():
        spans = secrets.order(secrets.base_spans(r.text) + secrets.confirmed_spans(r.text))
        assert after[id].text == secrets.redacted(r.text, spans, pipeline.SECRET) and after[id].n_chars == len(after[id].text)
    assert "token=" not in after[9004].text


def test_mixture_draws_as_poisson(stages, spark):
    docs, copies = stages[3].collect(), Counter(tuple(r) for r in stages[4].collect())
    assert set(copies) <= {tuple(r) for r in docs}
    sources = Counter(r.source for r in docs)
    share = {s: n**pipeline.TEMPER for s, n in sources.items()}
    rate = {s: share[s] / sum(share.values()) * len(docs) / n for s, n in sources.items()}
    import hashlib
    import math

    for r in docs:
        body = hashlib.md5(r.text.encode()).hexdigest()
        key = f"3|{'null' if r.doc_id is None else r.doc_id}|{body}|1"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        assert rate[r.source] <= 16
        total = term = math.exp(-rate[r.source])
        count = 0
        while total <= u:
            count += 1
            term *= rate[r.source] / count
            total += term
        assert copies.get(tuple(r), 0) == count


def test_packing_holds_every_copy(stages):
    copies, pieces = stages[4].collect(), stages[5].collect()
    want = Counter()
    for r in copies:
        want[r.doc_id] += len(ids_of(r.text))
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want


def test_run_is_its_stages(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} <= {i for i, _ in docs} and len(got) > 100
    clean = {i: t for i, t in docs if secrets.base_spans(t) == [] and secrets.confirmed_spans(t) == []}
    once = {i for i, n in Counter(r.doc_id for r in got if r.start == 0).items() if n == 1} & set(clean)
    whole = [r for r in got if r.doc_id in once]
    assert sum(r.length for r in whole) == sum(len(ids_of(clean[i])) for i in once)


def test_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = kept(stage(spark, docs, SF))
    assert docs.count() == 0


