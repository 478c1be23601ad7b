"""Compression bands see all of a text, wherever a part of it stands."""

import base64
import random

import pytest
import zstandard

from gaugeworks.llm import quality_rules

RNG = random.Random(4)
WORDS = ["".join(RNG.choices("etaoinshr", k=RNG.randint(2, 8))) for _ in range(4000)]
PROSE = " ".join(WORDS).encode()
SPAM = b"buy it now, " * 400
NOISE = base64.b85encode(RNG.randbytes(6000))


def passes(text):
    return quality_rules.compression(text, zstandard.ZstdCompressor(level=quality_rules.LEVEL).compress)[3]


@pytest.mark.parametrize("part", [SPAM[:4095], NOISE[:4095]])
@pytest.mark.parametrize("size", [4096, 8192, 12_288])
def test_the_end_counts_like_the_front(part, size):
    assert passes(PROSE[:size])
    assert not passes(PROSE[:size] + part)
    assert not passes(part + PROSE[:size])


def test_texts_below_two_chunks_are_checked():
    assert passes(PROSE[:8191]) and passes(PROSE[:4096])
    assert not passes(PROSE[:4100] + NOISE[:4091])


def test_a_tenth_may_be_odd():
    long = PROSE[:16_384]
    assert passes(long + SPAM[:1000]) and passes(long + long[::-1] + SPAM[:4096] + PROSE[:4500])


def test_every_byte_is_in_a_chunk():
    for size, chunks in ((4095, 0), (4096, 1), (4097, 2), (8191, 2), (8192, 2), (8193, 3)):
        seen = []
        quality_rules.compression(bytes(k % 251 for k in range(size)), lambda b: seen.append(len(b)) or b)
        assert seen == [size] + [4096] * chunks
