"""What a worker goes on holding from one stage to the next."""

import random
import tracemalloc

import public_tokenizers

from cardsight.llm import sentencepiece_codec as spc


def test_an_encoder_of_many_words_stays_small():
    codec = spc.Encoder(spc.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    draw = random.Random(0)
    codec.encode("a few words first")
    tracemalloc.start()
    for _ in range(240):
        codec.encode(" ".join("".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(1000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 40 << 20
