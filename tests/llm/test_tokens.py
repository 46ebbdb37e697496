import random

import public_tokenizers
import pyarrow as pa
import pytest

from cvelake.llm.tokens import ChunkTokenizer
from helpers_llm import doc_rows, reference_ids

ODD = ["", "  ", " a  b\n\n c\t d\n", "<|endoftext|> x", "a<|endoftext|>\n", "\x1c!\x1ca  b", "é́ ́x  ΑΣ Σ", "don't  's\n\n\n x   ",
       "日本語 テスト　x", "a  b", "x" * 3000, "Word, word. WORD,. 'S ,", "\n", "a\n", "İstanbul, ſ. K,", "a \n b", "end.\nNext, ok."]


@pytest.mark.parametrize("name,drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_same_ids_as_the_library(spark, name, drops):
    rng = random.Random(5)
    alphabet = "ab É.,'!\n\t ñß12Σ  "
    texts = ODD + [r["text"] for r in doc_rows(spark)][:60] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    coder = ChunkTokenizer(public_tokenizers.path(name), drops, cache_chunks=500)  # the cache starts anew now and then
    for first in range(0, len(texts), 37):
        own = texts[first : first + 37]
        ids, sizes = coder.encode(own)
        at = 0
        for text, n in zip(own, sizes.tolist()):
            assert ids[at : at + n].tolist() == reference_ids(name, text), repr(text)
            at += n
        assert at == len(ids)


def test_byte_level_chunks_are_looked_up_once_a_call_and_encoded_many_at_a_time():
    """CPU seconds of op7: a repeated chunk costs no Python step, a new one no call of its own."""
    name = "byte_bpe_50k.json"
    coder = ChunkTokenizer(public_tokenizers.path(name), False)
    looked_up, sent = [], []

    class Index(type(coder.index)):
        def __getitem__(self, chunk):
            looked_up.append(chunk)
            return super().__getitem__(chunk)

    class Encoder:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return encoder.encode_batch_fast(texts, **options)

    encoder, coder.encoder, coder.index = coder.encoder, Encoder(), Index()
    text = " ".join(["start", *(f"w{i}ord, it's. e.g. <|endoftext|>" for i in range(600))])
    for texts in ([text, text], [text]):
        ids, sizes = coder.encode(texts)
        assert ids.tolist() == reference_ids(name, text) * len(texts) and len(set(sizes.tolist())) == 1
    assert len(looked_up) <= 2 * 610 and len(sent) <= 10


def test_joined_chunks_fall_back_where_blanks_do_not_tell_them_apart():
    name = "byte_bpe_50k.json"
    coder = ChunkTokenizer(public_tokenizers.path(name), False)
    coder.blank_first[:] = False
    texts = ["some words, then. others\n\n  and more ", "", "words"]
    ids, sizes = coder.encode(texts)
    assert ids.tolist() == [i for t in texts for i in reference_ids(name, t)]
    assert sizes.tolist() == [len(reference_ids(name, t)) for t in texts]


def test_byte_level_texts_of_an_arrow_slice():
    name = "byte_bpe_50k.json"
    texts = ["left out", "a.b,c 'tis.", "", "tab\tb", "é, ß.　x", "日本 x.", " ", "it's, x"]
    for kind in (pa.string(), pa.large_string()):
        ids, sizes = ChunkTokenizer(public_tokenizers.path(name), False).encode(pa.array(texts, kind).slice(1, 6))
        expected = [reference_ids(name, t) for t in texts[1:7]]
        assert ids.tolist() == [i for own in expected for i in own] and sizes.tolist() == [len(own) for own in expected]
    ids, sizes = ChunkTokenizer(public_tokenizers.path(name), False).encode(pa.array([], pa.string()))
    assert not len(ids) and not len(sizes)
