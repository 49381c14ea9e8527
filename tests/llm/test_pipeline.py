"""The pipeline against its stages' plain versions on a small corpus."""

import random

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from caseloom.llm import bpe
from caseloom.llm.registry import QUERIES


def corpus():
    draw = random.Random(8)
    syllables = ["ba", "ke", "lo", "mi", "tu", "ra", "se", "no", "vi"]
    make = lambda n: " ".join("".join(draw.choices(syllables, k=draw.randrange(2, 5))) for _ in range(n))
    items, passage = [(i, make(30)) for i in range(3)], make(120)
    docs, labels = [], []
    for i in range(200):
        text, toxic = make(draw.randrange(60, 160)), int(i % 4 == 1)
        if toxic:
            text = " ".join(f"zgru{w}" if at % 8 == 0 else w for at, w in enumerate(text.split()))
        docs.append([i, text])
        labels.append((i, 1, toxic))
    for i in (4, 8, 12):
        docs[i][1] += " " + passage
    docs[16][1] += " " + items[1][1] + " " + make(20)
    docs += [[200, docs[0][1]], [201, docs[2][1] + " one more"], [202, None], [203, ""], [None, make(80)]]
    return [tuple(d) for d in docs], labels, items, passage


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    docs, labels, items, passage = corpus()
    base = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, docs, labels, passage


def test_pipeline(spark, tables):
    base, docs, labels, passage = tables
    toxic = {k for k, _, t in labels if t}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, base).collect()}
    expected = {k for k, _ in docs} - toxic - {200, 201, 16}
    assert set(out) == expected
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for k, text in docs:
        if k in expected:
            left = coder.decode(out[k].ids)
            if k in (4, 8, 12):
                assert passage[50:-50] not in left and left.startswith(text[:50])
            else:
                assert left == (text or "")
            assert out[k].ids == coder.encode_ordinary(left)


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables[0]).columns == docs.columns, name
        assert stage(spark, docs.limit(0), tables[0]).count() == 0, name


def test_passages_of_over_fifty_words_go(spark, tmp_path):
    draw = random.Random(5)
    make = lambda n: " ".join("".join(draw.choices("abcdefgh", k=draw.randrange(3, 8))) for _ in range(n))
    passage, item = make(51), make(60)
    assert 256 <= len(passage) < 400
    rows = [(i, make(60) + " " + passage * (i < 3) + item * (i > 5) + " " + make(60)) for i in range(8)]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path)).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    left = {r.doc_id: r.text for r in kept.collect()}
    assert all((left[i] == text) == (i >= 3) and passage not in left[i] for i, text in rows)
    # A repeated benchmark passage is not cut out: its documents go as a whole.
    clean = corpus_pipeline.decontaminate(spark, kept, str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == list(range(6))


def test_registration():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(QUERIES) <= set(names)


