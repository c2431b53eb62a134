import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cardsight.llm import sentencepiece_codec as codec
from cardsight.llm import token_count

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(n=4000):
    rnd = random.Random(2)
    parts = list("aabcdeethion▁ \n\t<>/s0123é漢字😀①ﬁ́ÀÖßñ.,\"'") + ["the ", "  ", "ing", "<s>", "<0x0A>", "�", "<|endoftext|>", "'s", " \n "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return texts + ["", " ", "a" * 3000, " " * 3000, "▁" * 100, "1" * 2000, "the" * 2000, "\x85   x᠎​　y １２ ² ½ ᛮ"]


def test_codec_equals_the_library(sp):
    model = codec.read_model(MODEL)
    own, back = codec.Encoder(model), codec.Decoder(model)
    for text in random_texts():
        ids = sp.encode(text)
        assert own.encode(text) == np.array(ids, "<u4").tobytes(), text
        assert back.decode(np.array([1, *ids, 2], "<u4").tobytes()) == sp.decode([1, *ids, 2])


def test_prefix_table_stores_the_last_token_of_every_prefix():
    own = codec.Encoder(codec.read_model(MODEL))
    word = codec.SPACE + "unbelievableness"
    whole = own._tokens_of(word)
    for n in range(1, len(word) + 1):
        tokens = own._tokens_of(word[:n])
        assert "".join(own.tokens[t] for t in tokens) == word[:n]
        assert all(own._compatible(a, b) for a, b in zip(tokens, tokens[1:]))
    assert len(whole) < len(word)


def expected(sp, rows):
    out = []
    for i, t, _ in rows:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        packed = np.array(ids, "<u4").tobytes()
        out.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    return sorted(map(str, out))


def test_encode_and_decode_odd_rows(odd_docs, odd_rows, sp):
    got = codec.digest(codec.decode(codec.encode(odd_docs, MODEL), MODEL)).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(sp, odd_rows)


def test_encode_whole_table(spark, sp):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = codec.digest(codec.decode(codec.encode(docs, MODEL), MODEL)).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(sp, [(r["doc_id"], r["text"], None) for r in docs.collect()])


def test_empty_tables(no_docs):
    assert codec.digest(codec.decode(codec.encode(no_docs, MODEL), MODEL)).collect() == []
    assert token_count.count_tokens(no_docs, BYTE_BPE).collect() == []


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        token_count.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_equal_the_library_on_random_texts():
    spec = token_count.read_tokenizer(BYTE_BPE)
    chunks = token_count.Chunks(token_count.Pretokens(spec), token_count.Lengths(spec, {" the": 1}))
    library = Tokenizer.from_file(BYTE_BPE)
    for text in random_texts():
        assert chunks.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_counts_of_odd_rows_and_the_whole_table(spark, odd_docs, odd_rows):
    library = Tokenizer.from_file(BYTE_BPE)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for frame, rows in ((odd_docs, odd_rows), (docs, [(r["doc_id"], r["text"], None) for r in docs.collect()])):
        want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
        got = token_count.count_tokens(frame, BYTE_BPE).collect()
        assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))


def test_frequent_table_is_bounded(odd_docs):
    spec = token_count.read_tokenizer(BYTE_BPE)
    table = token_count.frequent_lengths(odd_docs.where("text IS NOT NULL").select("text"), spec, entries=5)
    assert len(table) == 5 and all(n >= 1 for n in table.values())
