"""The corpus pipeline: each stage against what it is told to do, on odd rows and on the given documents."""

import corpus_pipeline as P
from conftest import SF_SMALL
from ledgerline.llm import langid, mixing
from ledgerline.plans.lineage import cut
from test_jaccard import brute

PROSE = "the cat sat on the mat and looked at the dog that lay by the door of the house "


def docs(spark):
    rows = [(i, f"{PROSE * 3} number {i} of {'many ' * (i % 5)}things", "en", f"s{i % 3}") for i in range(30)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, "123 456", "en", "s1"), (5, rows[5][1], "en", "s2"), (None, PROSE * 2, None, None),
             (200, PROSE * 2000, "en", "s0"), (201, "le chat est sur le tapis et regarde le chien " * 4, "fr", "s1")]
    return spark.createDataFrame([(i, t, x, s, len(t or "")) for i, t, x, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_one_by_one(spark):
    d = docs(spark)
    columns = d.columns
    first = cut(P.language_id(spark, d, ""))
    ids = {r["doc_id"] for r in first.collect()}
    assert first.columns == columns and ids.isdisjoint({100, 101, 102}) and {0, 200, 201, None} <= ids

    second = cut(P.near_duplicates(spark, first, ""))
    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    kept = sorted(str(r["doc_id"]) for r in second.collect())
    want = {c for _, _, c in brute(rows, 5, 80, 100)}
    assert second.columns == columns and kept == sorted(map(str, want))

    third = cut(P.mix_sources(spark, second, ""))
    taken = mixing.decided(mixing.plan(second)).toPandas()
    assert third.columns == columns
    assert sum(len(r["text"].split()) for r in third.collect()) == taken["taken"].sum()

    last = P.pack_sequences(spark, third, "").toPandas()
    assert len(last[last["piece"] == 0]) == third.count()
    assert last.groupby("sequence_id")["length"].sum().max() <= 4096


def test_run_over_the_given_documents(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "mix_sources", "pack_sequences"]


def test_clean_documents_stay(spark):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = langid.accepted(given, langid.train(langid.labelled_rows(given)))
    assert kept.count() == given.where("text RLIKE '[a-zA-Z]'").count()


def test_empty_table(spark):
    d = docs(spark).where("false")
    for _, stage in P.STAGES:
        d = cut(stage(spark, d, ""))
    assert d.count() == 0
