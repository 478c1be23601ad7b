"""Plain versions of what the text queries return, straight from their contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKENS = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORDS.findall(lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ids(text, tokenizer=Tokenizer.from_file(TOKENIZER)):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def crc(values):
    return zlib.crc32(np.asarray(values, "<u4").tobytes())


def base_scores(docs):
    """doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)."""
    count, rows = Counter(), []
    for doc, text in docs:
        tokens = [*TOKENS.findall(lower(text)), None]
        held = zlib.crc32(str("" if doc is None else doc).encode()) % 7 == 2
        rows.append((doc, held, tokens))
        if not held:
            count.update(tokens)
    n, v = count.total(), len(count)
    return [
        (doc, held, len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)) for doc, held, t in rows
    ]


def licenses(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    found, tokens = [], words(text)
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.split()
        found += [(k, label) for k in range(len(tokens)) if tokens[k : k + len(p)] == p]
    places = [k for k, _ in found]
    return len(tokens), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in found}))


def pieces(text, size=4096):
    all_ids = ids(text)
    return [(k, k * size, len(all_ids[k * size : (k + 1) * size]), crc(all_ids[k * size : (k + 1) * size])) for k in range(-(-len(all_ids) // size))]


KINDS = ("assign", "access", "hex")


def base_secrets(text):
    text = text or ""
    spans = [
        ("assign", *m.span())
        for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 8
    ]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def leaks(docs, items, window=10):
    """Per document: n_words, n_hit, items."""
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[k : k + window])].add(item)
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in owners}:
            for k in range(len(w) - size + 1):
                if (key := tuple(w[k : k + size])) in owners:
                    hit.update(range(k, k + size))
                    found |= owners[key]
        out.append((len(w), len(hit), {str(x) for x in found if x is not None}))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = TOKENS.findall(text)
    lines = [x for x in text.split("\n") if TOKENS.search(x)]
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = set()
    for k in range(len(w) - 7):
        if windows[tuple(w[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def shingles(text):
    w = words(text)
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])


def near_classes(docs, threshold=0.8):
    """Row number: the row numbers of its class, from all pairs that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    first, having = {}, defaultdict(list)
    for k, (_, text) in enumerate(docs):
        key = tuple(words(text)) or (text or "")
        if key in first:
            join(first[key], k)
            continue
        first[key] = k
        both = Counter()
        for s, n in sets[k].items():
            for j in having[s]:
                both[j] += min(n, sets[j][s])
            having[s].append(k)
        for j, n in both.items():
            if n / (sets[k].total() + sets[j].total() - n) >= threshold:
                join(j, k)
    classes = defaultdict(list)
    for k in range(len(docs)):
        classes[find(k)].append(k)
    return {k: c for c in classes.values() for k in c}
