"""Large ids beside nulls stay exact in every operator."""

from colloquy.llm import descent, importance, media, mixing, packing, sharding, simhash, suffix, token_counts
import public_tokenizers

BIG = [2**60 + 1, 2**60 + 3, None, 2**53 + 1]


def test_large_ids(spark):
    docs = spark.createDataFrame([(i, f"text {k} of some words", "s") for k, i in enumerate(BIG)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(BIG[0], 1, 0)], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([(i, [1.0, float(k)]) for k, i in enumerate(BIG)], "vec_id long, embedding array<double>")
    outs = {
        "mix": mixing.mix(docs), "pack": packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")), "suffix": suffix.removals(docs), "media": media.digests(media.store_media(docs)),
        "tensors": media.read_media(media.store_media(docs)), "shard": sharding.shard(docs), "tokens": token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")),
        "quality": importance.resample(docs, labels), "simhash": simhash.near_duplicates(docs), "vectors": descent.near_duplicates(vectors),
    }
    for name, out in outs.items():
        assert sorted((r[0] for r in out.select(out.columns[0]).collect()), key=str) == sorted(BIG, key=str), name
    assert {r.component_id for r in outs["vectors"].collect()} <= set(BIG)
