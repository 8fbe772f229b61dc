import public_tokenizers as P
import pytest
import tokenizers

from quartier.llm import tokencount as t
from quartier.session import scratch_path

ODD = ["a" + chr(c) + "b !" + chr(c) + "! " + chr(c) + " x" + chr(c) for c in
       [9, 10, 11, 13, 28, 31, 0x85, 0xA0, 0x2003, 0x200B, 0x2028, 0x3000, 0xFEFF, 0x301]]
ODD += ["it's we'll 'S don't", "  two  spaces\n\n\n tab\t ", "a,b.c!!??;: .,!? ...a", " A.", "Hello,World. x.,y!"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(name, edge_rows):
    texts = [x or "" for _, x in edge_rows] + ODD
    if name.endswith(".model"):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        want = [len(x) for x in lib.encode(texts)]
    else:
        lib = tokenizers.Tokenizer.from_file(P.path(name))
        want = [len(lib.encode(x, add_special_tokens=False).ids) for x in texts]
    assert t.Counter(P.path(name)).count(texts) == want


def test_cache_is_joined_and_appended(spark, edge_docs, edge_rows, no_docs):
    path, cache = P.path("byte_bpe_50k.json"), scratch_path(spark, "tokens")
    lib = tokenizers.Tokenizer.from_file(path)
    want = sorted(((i, len((x or "").encode()), len(lib.encode(x or "").ids)) for i, x in edge_rows), key=str)

    def run(docs):
        return sorted((tuple(r) for r in t.count_tokens(docs, path, cache).collect()), key=str)

    assert run(edge_docs) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({x or "" for _, x in edge_rows})
    assert run(edge_docs) == want and spark.read.parquet(cache).count() == stored  # all hits
    more = spark.createDataFrame([(1, "a new text"), (2, "one")], "doc_id long, text string")
    assert len(run(more)) == 2 and spark.read.parquet(cache).count() == stored + 1
    # another tokenizer version shares nothing
    other = t.count_tokens(more, P.path("word_bpe_49k.json"), cache).collect()
    assert len(other) == 2 and spark.read.parquet(cache).count() == stored + 3
    assert run(no_docs) == []


def test_unique_ids_drop_copies_in_place(spark):
    docs = spark.createDataFrame([(i, f"text {i % 5}") for i in range(40)], "doc_id long, text string")
    cache = scratch_path(spark, "tokens")
    assert t.count_tokens(docs, P.path("byte_bpe_50k.json"), cache).count() == 40
    assert spark.read.parquet(cache).count() == 5
