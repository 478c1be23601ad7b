"""Key encodings that are confirmed by their structure, letters, and links at the threshold."""

import base64
import random

import pytest

from gaugeworks.llm import language, near_dedup, secrets
from gaugeworks.llm.columns import share_code

RNG = random.Random(3)


def der(tag, content):
    size = len(content)
    length = bytes([size]) if size < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(size.to_bytes((size.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + length + content


def sequence(*parts):
    return der(0x30, b"".join(parts))


def integer(size):
    return der(2, bytes([RNG.randrange(1, 128)]) + RNG.randbytes(size - 1))


def field(data):
    return len(data).to_bytes(4, "big") + data


def b64(data):
    return base64.b64encode(data).decode()


def pem(name, body, headers=""):
    text = b64(body)
    return f"-----BEGIN {name}-----\n{headers}" + "\n".join(text[k : k + 64] for k in range(0, len(text), 64)) + f"\n-----END {name}-----"


OID = der(6, bytes.fromhex("2a864886f70d01050d"))
RSA = sequence(der(2, b"\0"), *[integer(n) for n in (128, 3, 128, 64, 64, 64, 64, 64)])
DSA = sequence(der(2, b"\0"), *[integer(n) for n in (128, 20, 128, 128, 20)])
PKCS8 = sequence(der(2, b"\0"), sequence(der(6, bytes.fromhex("2b6570"))), der(4, RNG.randbytes(34)))
ENCIPHERED = sequence(sequence(OID, sequence(der(4, RNG.randbytes(8)), der(2, b"\x08\x00"))), der(4, RNG.randbytes(48)))
SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(field(b"ssh-ed25519") + field(RNG.randbytes(32))) + field(RNG.randbytes(136))
HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"


def kinds(text):
    return {k for k, *_ in secrets.confirmed_spans(text)}


@pytest.mark.parametrize("key, kind", [(RSA, "der"), (DSA, "der"), (PKCS8, "der"), (ENCIPHERED, "der"), (SSH, "ssh")])
def test_keys(key, kind):
    text = f"x {b64(key)} y"
    assert kinds(text) == {kind}
    assert kinds(f"x {key.hex()} y") == {kind}
    assert kinds(f"x {b64(b64(key).encode())} y") == kinds(f"x {b64(key.hex().encode())} y") == {"wrapped"}
    assert kinds(b64(b64(b64(key).encode()).encode())) == set()  # two layers at most
    for broken in (key[:-1], key[:40] + key[41:], *([key + b"\0"] if kind == "der" else [])):
        assert kinds(f"x {b64(broken)} y") == set()


@pytest.mark.parametrize("name, key", [("RSA PRIVATE KEY", RSA), ("DSA PRIVATE KEY", DSA), ("ENCRYPTED PRIVATE KEY", ENCIPHERED), ("OPENSSH PRIVATE KEY", SSH), ("PRIVATE KEY", PKCS8)])
def test_armour(name, key):
    assert ("pem", 2, 2 + len(pem(name, key))) in secrets.confirmed_spans(f"a {pem(name, key)} b")
    with_comment = pem(name, key, "Comment: my key\n")
    assert ("pem", 0, len(with_comment)) in secrets.confirmed_spans(with_comment)


def test_enciphered_armour():
    assert kinds(pem("RSA PRIVATE KEY", RNG.randbytes(320), HEADERS)) == {"pem"}
    for body, headers in ((RNG.randbytes(321), HEADERS), (RNG.randbytes(320), ""), (RNG.randbytes(320), HEADERS.replace("EEFF", "")), (RNG.randbytes(320), "Comment: x\n")):
        assert "pem" not in kinds(pem("RSA PRIVATE KEY", body, headers))


def test_an_algorithm_that_enciphers_nothing_is_no_key():
    assert kinds(b64(sequence(sequence(der(6, bytes.fromhex("2b6570"))), der(4, RNG.randbytes(48))))) == set()


def test_ssh_counts_its_keys():
    two = SSH.replace(b"\0\0\0\1\0\0\0\x33", b"\0\0\0\2\0\0\0\x33", 1)
    assert two != SSH and kinds(b64(two)) == set()


@pytest.mark.parametrize("text, letter", [("½ ² ①②", False), ("Ⅷ", False), ("٣4_", False), ("é", True), ("1 日", True), ("ª", True), ("", False)])
def test_letters(text, letter):
    assert language.has_letter(text.encode()) is letter


def test_no_link_is_lost_between_the_threshold_and_a_little_more(spark):
    """Pairs of texts that share 0.80 to 0.85 of their five-word shingles, no third text to join them."""
    share_code(spark)
    rng = random.Random(11)
    rows, pairs = [], 0
    while pairs < 400:
        words = [f"w{rng.randrange(10**7)}" for _ in range(200)]
        other = list(words)
        cut = rng.randrange(18, 22)  # replaces a run at the end: cut shingles go, cut come
        other[-cut:] = [f"v{rng.randrange(10**7)}" for _ in range(cut)]
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, other))
        if 0.80 <= len(a & b) / len(a | b) <= 0.85:
            rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(other))]
            pairs += 1
    found = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lost = [k for k in range(pairs) if found[2 * k] != found[2 * k + 1]]
    assert len(lost) <= 1 and len(set(found.values())) == pairs + len(lost)
