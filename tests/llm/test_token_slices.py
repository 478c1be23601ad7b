"""Token files look a word up once in a large piece of text, however it is dealt out."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from gaugeworks.llm import token_files, tokens
from gaugeworks.llm.columns import as_values, slices


def test_a_word_is_looked_up_once_in_a_piece():
    texts = ["alpha beta gamma delta " * 22_000] * 24  # 12 MB
    batch = pa.RecordBatch.from_pydict({"id": list(range(24)), "body": texts})
    encoder = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), remembered=0)
    asked = []
    lookup = encoder._lookup
    encoder._lookup = lambda words: asked.extend(words) or lookup(words)
    found = [encoder.encode(as_values(piece.column(1)), 1) for piece in slices(batch, [1], token_files.ENCODED_BYTES)]
    assert sorted(asked) == [b"alpha", b"beta", b"delta", b"gamma"]
    assert sum(len(at) - 1 for _, at in found) == 24


def test_empty_texts_and_ends():
    encoder = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, b"", b"  ", b"a b.", None, b"caf\xc3\xa9, a", b""]
    for end in (None, 1):
        flat, at = encoder.encode(texts, end)
        for k, text in enumerate(texts):
            ids = encoder.tokenizer.encode((text or b"").decode(), add_special_tokens=False).ids
            assert flat[at[k] : at[k + 1]].tolist() == ids + ([end] if end else [])
        assert at[-1] == len(flat)
    flat, at = encoder.encode([], 1)
    assert len(flat) == 0 and np.array_equal(at, [0])
