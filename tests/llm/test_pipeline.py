from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_documents import brute_components
from indicator_engine.llm.language_id import has_letter
from indicator_engine.llm.mixing import mix


def test_stages_on_awkward_rows(spark, awkward, awkward_rows, tmp_path):
    """Each stage against a plain version on what the one before it kept."""
    docs = awkward.dropDuplicates(["doc_id"]).where("doc_id IS NOT NULL")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = stage(spark, docs, "")
        ids = Counter(r.doc_id for r in after.select("doc_id").collect())
        if name == "language_id":
            assert ids == Counter(i for i, t in before.items() if has_letter(t))
        elif name == "exact_dedup":
            least = {}
            for i, t in before.items():
                norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
                least[norm] = min(least.get(norm, i), i)
            assert ids == Counter(least.values())
        elif name == "near_dedup":
            assert ids == Counter(i for i, _, _, kept in brute_components(list(before.items()), 5, 80) if kept)
        elif name == "mixing":
            times = {r.doc_id: -(-r.taken // r["size"]) for r in mix(docs).collect() if r["size"]}
            assert ids == +Counter(times)
        if name != "sentence_pieces":
            assert after.columns == docs.columns
            path = f"{tmp_path}/{name}"
            after.write.parquet(path)
            docs = spark.read.parquet(path)
        else:
            assert ids == Counter(r.doc_id for r in docs.select("doc_id").collect())
            assert "text" not in after.columns and {"piece_ids", "piece_scores"} <= {*after.columns}


def test_stages_keep_the_values_of_all_columns(spark, awkward):
    """Columns named like those an operator adds keep their own values."""
    own = ("score", "kept", "group_size", "keep_id", "lang_pred", "text_sha256", "_near_row", "_id", "component_id")
    docs = awkward.withColumns({c: F.lit(f"own {c}") for c in own})
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
        rows = docs.select(*own).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"own {c}" for c in own)]


def test_run(spark, small):
    """All stages in a row against plain ones: which documents are left, how often, and their encoding."""
    table = spark.read.parquet(f"{small}/documents.parquet").collect()
    left = {r.doc_id: (r.text or "", r.source) for r in table if has_letter(r.text)}
    assert len({r.doc_id for r in table}) == len(table)
    least = {}
    for i, (t, _) in left.items():
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        least[norm] = min(least.get(norm, i), i)
    texts = [(i, left[i][0]) for i in sorted(least.values())]
    kept = [i for i, _, _, stays in brute_components(texts, 5, 80) if stays]
    frame = spark.createDataFrame([(i, *left[i]) for i in kept], "doc_id long, text string, source string")
    times = {r.doc_id: -(-r.taken // r["size"]) for r in mix(frame).collect() if r["size"]}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = corpus_pipeline.run(spark, small).select("doc_id", "piece_ids").collect()
    assert Counter(r.doc_id for r in rows) == +Counter(times)
    assert all(list(r.piece_ids) == model.encode(left[r.doc_id][0]) for r in rows)


def test_empty_table(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_other_text_of_a_dropped_row_s_id_stays(spark):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:50], "x", *words[51:]]
    rows = [
        (3, " ".join(words)),
        (26, " ".join(near)),
        (26, " ".join(f"v{i}" for i in range(100))),
        (26, None),
        (30, " ".join(f"v{i}" for i in range(99))),
        (None, " ".join(words)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.near(spark, docs, "").collect())
    assert left == Counter([rows[0], rows[2], rows[3], rows[5]])


def test_near_stage_with_repeated_ids(spark, awkward, awkward_rows):
    before = [(i, t) for i, t, *_ in awkward_rows]
    ids = Counter(r.doc_id for r in corpus_pipeline.near(spark, awkward, "").select("doc_id").collect())
    expected = Counter()
    for (i, _, _, kept), n in brute_components(before, 5, 80).items():
        expected[i] += n * kept
    assert ids == +expected
