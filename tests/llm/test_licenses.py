import re
from collections import Counter

from optionflow.llm import licenses
from optionflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    """n_words, n_base, first_word, last_word, base_labels of a text."""
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def scan(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, labels string")
    return licenses.scan(df).collect()


def base(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def notice(label, nth=0):
    return [t for l, t in licenses.NOTICES if l == label][nth]


def test_base_places_equal_brute_force(spark):
    texts = [
        "", None, "x", "MIT License", "the mit-license: MIT   license, mit.license mit licenses", "GNU General Public License " * 50,
        "gnu general public gnu general public license", "cc by cc by-nc CC\nBY", "apache\x00license apache é license apacheé license",
        "ＭＩＴ license mİt license mit  license K", "9cc by cc by9 cc by", "mit " * 300 + "license " * 3, "apache license" + " pad" * 60_000 + " cc by",
    ]
    got = {r.doc_id: r for r in scan(spark, list(enumerate(texts)))}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        assert base(got[k]) == brute(t), t
        assert set(filter(None, got[k].base_labels.split(","))) <= set(got[k].labels.split(","))
        assert 0 <= got[k].score <= 1 and (got[k].score == 1 or not got[k].n_base)


def test_edited_notices_are_found_across_neighbouring_diagonals(spark):
    words = notice("mit", 1).split()
    edited = [*words[:7], "really", *words[7:15], *words[16:]]
    clean = "of the software without any of the terms of this work to use and to copy the file under this"
    rows = [
        (1, "intro words " + " ".join(edited) + " and more"), (2, " ".join(words[:8])), (3, clean),
        (4, " ".join(w for p in zip(words, ["x"] * 99) for w in p)), (5, notice("bsd").upper() + ". " + notice("unlicense")),
    ]
    got = {r.doc_id: r for r in scan(spark, rows)}
    assert got[1].labels == "mit" and 0.8 <= got[1].score < 1 and got[1].n_spans == 1 and got[1].base_labels == ""
    assert got[5].labels == "bsd,unlicense" and got[5].score == 1
    assert all(got[k].labels == "" and got[k].score == 0 for k in (2, 3, 4))


def test_notices_are_not_taken_for_their_siblings(spark):
    plain = [(k, text) for k, (_, text) in enumerate(licenses.NOTICES)]
    got = {r.doc_id: r for r in scan(spark, [(k, f"intro words {text} and more") for k, text in plain])}
    for k, text in plain:
        assert set(got[k].labels.split(",")) == {licenses.NOTICES[k][0], *filter(None, brute(text)[4].split(","))}, text
        assert got[k].score == 1 and got[k].n_spans == 1


def test_other_terms_are_no_edits(spark):
    gpl, lgpl = notice("gpl"), notice("lgpl")
    texts = {
        "Licensed under CC BY-NC 4.0.": {"cc-by", "cc-by-nc-4.0"}, "licensed under CC-BY-SA 4.0": {"cc-by", "cc-by-sa-4.0"},
        "licensed under CC BY-ND 4.0": {"cc-by"}, "licensed under CC BY-NC-SA 4.0": {"cc-by"}, "licensed under CC BY 3.0": {"cc-by"},
        notice("cc-by-4.0", 1).replace("attribution", "attribution noncommercial"): set(),
        notice("gpl-3.0").replace("3", "2"): {"gpl"}, notice("gpl-3.0").replace("gnu", "gnu affero"): set(),
        gpl.replace("gnu", "gnu affero"): set(), gpl.replace("gnu", "gnu lesser"): {"lgpl"}, lgpl.replace("lesser ", ""): {"gpl"},
        gpl.replace("program", "package"): {"gpl"}, lgpl.replace("library", "program"): {"lgpl"},
        notice("apache-2.0", 0).replace("2 0", "2 1"): {"apache"}, notice("apache-2.0", 1).replace("2 0", "1 1"): set(),
        notice("mpl-2.0").replace("2 0", "1 1"): set(),
        "licensed under the GNU General Public License (GPL) version 3": {"gpl", "gpl-3.0"},
        "Licensed under CC BY 4.0. The pictures are licensed under CC BY-NC 4.0.": {"cc-by", "cc-by-4.0", "cc-by-nc-4.0"},
    }
    got = {r.doc_id: r.labels for r in scan(spark, list(enumerate(texts)))}
    for k, (text, want) in enumerate(texts.items()):
        assert set(filter(None, got[k].split(","))) == want, text


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "mit license"), (1, "mit license"), (1, "other"), (None, "cc by"), (None, "cc by"), (None, None)]
    got = Counter((r.doc_id, r.n_words, r.n_base, r.labels) for r in scan(spark, rows))
    assert got == {(1, 2, 1, "mit"): 2, (1, 1, 0, ""): 1, (None, 2, 1, "cc-by"): 2, (None, 0, 0, ""): 1}
    assert scan(spark, []) == []


def test_op10_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_license_diagonals"](spark, SF).collect()
    assert len(got) == len(texts) and all(base(r) == brute(texts[r.doc_id]) for r in got)


def test_plan_is_native(spark):
    plan = QUERIES["op10_license_diagonals"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
