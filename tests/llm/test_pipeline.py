"""The corpus pipeline: every stage against a plain version on its own
input, and run() against the stages one by one."""

import regex

import test_decontaminate as contaminated
import test_packing as packed
import test_pii as private
import test_simhash as near

import corpus_pipeline
from conftest import SF001
from rivulet.llm import pii, toxicity
from rivulet.sources.tables import table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain_pii(text):
    if text is None:
        return None
    pattern = regex.compile(pii.WITH_EMAIL if "@" in text else pii.NUMBERS)
    return pattern.sub(lambda m: private.plain(m.group()), text)


def odd(spark):
    docs = table(spark, SF001, "documents").collect()
    extra = [(None, None, None, None, None), (None, "", "en", "s", 0), (9001, None, "en", "s", None),
             (docs[5].doc_id, docs[5].text, "en", "twin", 1), tuple(docs[7]), tuple(docs[7]),
             (9002, "card 4111 1111 1111 1111 of x@y.de", "en", "s", 1),
             (9003, "you idiot stupid trash scum moron " * 20, "en", "s", 1), (9004, "long " * 30_000, "en", "s", 1)]
    return spark.createDataFrame([tuple(d) for d in docs] + extra, table(spark, SF001, "documents").schema)


def test_stages_against_plain_versions(spark, tmp_path):
    assert corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    docs = odd(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        before = [(r.doc_id, r.text) for r in docs.collect()]
        if name != "packing":
            assert out.columns == columns
        if name == "toxicity":
            # the plain version: what the model says of each text alone
            model = toxicity.fit(docs, table(spark, SF001, "labels"))
            alone = model.add_score(docs.select("doc_id", "text"), "text", "score").collect()
            assert rows(out.select("doc_id", "text")) == sorted(
                ((r.doc_id, r.text) for r in alone if r.score < 0.5), key=str)
            assert out.count() < docs.count()
        elif name == "near_dedup":
            comp = near.brute_components([near.brute_fingerprint(t) for _, t in before])
            after = [(r.doc_id, r.text) for r in out.collect()]
            assert len(after) == len(set(comp))
            groups = {}
            for row, c in zip(before, comp):
                groups.setdefault(c, []).append(row)
            for c, members in groups.items():
                named = [m for m in members if m[0] is not None]
                least = min(m[0] for m in named) if named else None
                assert sum(a in members and a[0] == least for a in after) >= 1
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
            bad = [r[5] for r in (contaminated.brute([b], items)[0] for b in before)]
            assert any(bad)
            assert rows(out.select("doc_id", "text")) == sorted(
                (b for b, gone in zip(before, bad) if not gone), key=str)
        elif name == "pii":
            assert rows(out.select("doc_id", "text")) == sorted(((i, plain_pii(t)) for i, t in before), key=str)
            assert rows(out.drop("text")) == rows(docs.drop("text"))
        else:
            ids = packed.reference_ids([t for _, t in before])
            used, least = packed.check_packed(out.collect(), [(d, i) for (d, _), i in zip(before, ids)])
            assert used <= least + 2
        docs = out


def test_run_is_its_stages(spark, tmp_path):
    docs = table(spark, SF001, "documents")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    drop = ("sequence_id", "offset")  # any packing of the same pieces will do
    assert rows(corpus_pipeline.run(spark, SF001).drop(*drop)) == rows(docs.drop(*drop))


def test_empty_documents(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
