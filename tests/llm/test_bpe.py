import os
import random

import pytest

from inkmill.llm import tokens
from inkmill.llm.bpe import Bpe

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.BYTE_BPE_50K), reason="no vocabulary files here")
TEXTS = ["", " ", "hello world", "It's <|endoftext|> 12,345!", "世界の果て　と\u0085\x1c", "a" * 5000, "x\n\n\n  y\t", "🙂🙂 ﬁn", "no-​break\xa0space"]


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encode_and_count_as_the_published_library():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("aab éß世界 \n\t's1²🙂\u0085") for _ in range(rng.randrange(60))) for _ in range(800)]
    b, want = Bpe.load(tokens.BYTE_BPE_50K), reference(texts)
    assert b.encode(texts) == want
    assert b.count(texts) == [len(x) for x in want]
    assert [b.merge(t.encode()) for t in ("hello", "世界")] == [x for x in reference(["hello", "世界"])]


def test_lone_surrogates_and_nulls_have_ids():
    assert Bpe.load(tokens.BYTE_BPE_50K).encode([None, "", "a\ud800b"])[:2] == [[], []]


def test_small_caches_change_nothing():
    b = Bpe(Bpe.load(tokens.BYTE_BPE_50K).ranks, kept=3)
    assert b.encode(TEXTS) == reference(TEXTS) == b.encode(TEXTS)
    assert b.count(TEXTS) == [len(x) for x in reference(TEXTS)]


def test_operators_on_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (2, "", "t"), (None, "hello world", "t")], "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], r["ids"]) for r in tokens.encode(docs).collect()), key=str)
    assert got == sorted([(1, []), (1, []), (2, []), (None, reference(["hello world"])[0])], key=str)
    assert tokens.encode(docs.limit(0)).count() == 0


def test_budget(spark):
    rpg = spark.createDataFrame(
        [(1, "hello world", "My Lore", "EN-us", ("trpg",)), (2, None, "my_lore", "en", (None,)), (3, "hello", None, None, None)],
        "rec_id long, output string, source_id string, language string, metadata struct<category string>",
    )
    tr = spark.createDataFrame([(9, [("human", "hello"), ("gpt", None)], " my lore", "fr"), (10, None, "x", "de")], "rec_id long, conversations array<struct<from string, value string>>, source_id string, language string")
    src = spark.createDataFrame([("my_lore", "extra")], "source_id string, category string")
    one, two = (len(x) for x in reference(["hello", "hello world"]))
    records = tokens.count_records(rpg, tr)
    assert {(r["rec_id"], r["tokens"]) for r in records.collect()} == {(1, two), (2, 0), (3, one), (9, one), (10, 0)}
    got = {tuple(r) for r in tokens.budget(records, src).collect()}
    assert ("rpg_dataset", "my_lore", "en", "trpg", 1, two) in got and ("rpg_dataset", "my_lore", "en", "extra", 1, 0) in got
    assert ("rpg_dataset", None, None, None, 1, one) in got and ("lora_translator", "my_lore", "fr", "extra", 1, one) in got
    assert sum(r[5] for r in got) == two + 2 * one
