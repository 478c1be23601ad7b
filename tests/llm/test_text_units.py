"""The text operators' own parts, without Spark."""

import base64
import json
import random
import struct

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import decontaminate, language, licenses, near_dedup, packing, quality_model, quality_rules, rangecoder, secrets, suffix_tree, tokens
from gaugeworks.llm.columns import alnum_words, hashed, word_codes, word_hashes

texts = st.text(st.sampled_from("aAbZ \n\t\x0b\x1c\x85é́İΣς日'’.,!-*|<>$0_K 🙂"), max_size=60)
short_settings = settings(max_examples=150, deadline=None)


@given(texts)
@short_settings
def test_words_follow_their_pattern(text):
    assert [w.decode() for w in alnum_words(text.encode())] == plain.words(text)
    codes, distinct, at = word_codes([text.encode(), None, text.encode()], suffix_tree._TABLE)
    expected = plain.TOKENS.findall(plain.lower(text))
    assert [distinct[c].decode() for c in codes] == expected * 2
    assert at.tolist() == [0, len(expected), len(expected), 2 * len(expected)]
    assert word_hashes([text.encode()])[0].tolist() == hashed(alnum_words(text.encode())).tolist()


class TestTokens:
    @given(st.lists(st.one_of(st.none(), texts, st.sampled_from(["<|endoftext|>x", "we'Ll don't", "a.b,c!!", "H̱ K"])), max_size=6))
    @short_settings
    def test_as_whole_texts(self, rows):
        few = tokens.WordEncoder(plain.TOKENIZER, remembered=2)
        for _ in range(2):
            ids, at = few.encode([None if r is None else r.encode() for r in rows], 1)
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.ids(r).tolist() for r in rows]

    @given(st.lists(st.text(st.sampled_from("abehstz\u00df\u00e9\u00f1\u00f6\u00f7\u00f8\u00ff\u00d7\u00aa\u00ad\u0131\u0142A' \u0301."), max_size=30), max_size=4))
    @short_settings
    def test_words_by_the_model_alone(self, rows):
        whole = tokens.WordEncoder(plain.TOKENIZER, remembered=0)
        assert whole.pieces is not None
        found = [x.tolist() for x in whole.encode([r.encode() for r in rows])]
        assert [found[0][a:b] for a, b in zip(found[1], found[1][1:])] == [plain.ids(r).tolist()[:-1] for r in rows]
        whole.pieces = None
        assert [x.tolist() for x in whole.encode([r.encode() for r in rows])] == found

    def test_letters_that_stand_alone(self):
        whole = tokens.WordEncoder(plain.TOKENIZER)
        for c in map(chr, range(0x61, 0x180)):
            word = f"a{c}b{c}"
            ids, _ = whole.encode([word.encode()])
            assert ids.tolist() == whole.tokenizer.encode(word, add_special_tokens=False).ids

    def test_without_end(self):
        ids, at = tokens.encoder(plain.TOKENIZER).encode([b"a b", b"", b"a"])
        assert at.tolist() == [0, 2, 2, 3] and ids[:1].tolist() == ids[2:].tolist()


class TestRangeCoder:
    @given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**32 - 1)), max_size=40), max_size=5), st.sampled_from([3, 8, 1024]))
    @short_settings
    def test_round_trip(self, documents, block):
        rows = [np.array(d, "<u4").tobytes() for d in documents]
        names = [None if k % 3 == 1 else k - 2 for k in range(len(rows))]
        frame = rangecoder.Frame(rangecoder.pack_frame(names, rows, block))
        assert frame.documents() == rows and frame.doc_ids == names

    @pytest.mark.parametrize("largest", [2, 300, 49_408, 2**32 - 1])
    def test_many_blocks(self, largest, monkeypatch):
        monkeypatch.setattr(rangecoder, "TOGETHER", 3)
        rng = np.random.default_rng(largest)
        ids = rng.integers(0, largest, 9_001, dtype=np.uint64).astype("<u4")
        ids[4000:6000] = ids[:2000]
        frame = rangecoder.Frame(rangecoder.pack_frame([1], [ids.tobytes()]))
        assert frame.documents() == [ids.tobytes()]
        assert [b.tolist() for b in frame.blocks([8, 2])] == [ids[8192:].tolist(), ids[2048:3072].tolist()]

    def test_repetition_shrinks(self):
        ids = np.tile(np.arange(20, dtype="<u4") * 97, 2000)
        assert len(rangecoder.pack_frame([1], [ids.tobytes()])) < len(ids) * 4 / 40

    def test_predictions_save_bits(self):
        """Fewer bits than the ids' order-0 entropy where followers tell something, hardly more where they don't."""
        rng = np.random.default_rng(3)
        alone = rng.geometric(0.01, 100_000).astype("<u4") * 11
        counts = np.unique(alone, return_counts=True)[1] / len(alone)
        entropy = -(counts * np.log2(counts)).sum() * len(alone) / 8
        assert len(rangecoder.pack_frame([1], [alone.tobytes()])) < 1.08 * entropy + 30_000
        led = alone.copy()
        led[1::2] = led[::2] * 7 % 1009
        counts = np.unique(led, return_counts=True)[1] / len(led)
        entropy = -(counts * np.log2(counts)).sum() * len(led) / 8
        assert len(rangecoder.pack_frame([1], [led.tobytes()])) < 0.75 * entropy

    @pytest.mark.parametrize("step", [1, 4099])
    def test_very_many_symbols(self, step):
        ids = np.random.default_rng(1).permutation(1_048_577).astype("<u4")[:200_000] * np.uint32(step)
        frame = rangecoder.Frame(rangecoder.pack_frame([1], [ids.tobytes()]))
        assert frame.documents() == [ids.tobytes()]

    def test_damage_is_found(self):
        ids = np.arange(3000, dtype="<u4")
        data = bytearray(rangecoder.pack_frame([1], [ids.tobytes()]))
        for place in (0, 30, 60, len(data) - 500):
            broken = bytearray(data)
            broken[place] ^= 0x55
            with pytest.raises(ValueError):
                rangecoder.Frame(bytes(broken)).documents()
        with pytest.raises(ValueError):
            rangecoder.Frame(bytes(data[:40]))


class TestPacking:
    @given(st.lists(st.integers(1, 100), min_size=1, max_size=80), st.integers(0, 5))
    @short_settings
    def test_groupings_hold_each_piece_once(self, lengths, seed):
        rng = random.Random(seed)
        first = packing.best_fit(lengths, list(range(len(lengths))), [], 100)
        other = packing.disturbed(lengths, rng, 100)
        child = packing.crossover(lengths, first, other, rng, 100)
        for bins in (first, other, child, packing.mutation(lengths, child, rng, 100), *packing.evolve(lengths, [other], seed, 100)):
            assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
            assert all(0 < sum(lengths[i] for i in b) <= 100 for b in bins)
            assert packing.as_bins(packing.as_places(bins, len(lengths))) == [sorted(b) for b in bins]
        assert len(packing.evolve(lengths, [], seed, 100)[0]) <= len(first)

    def test_generations_improve_on_best_fit(self):
        lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6] * 6  # best fit decreasing isn't optimal here
        first = packing.best_fit(lengths, list(range(len(lengths))), [], 60)
        best = packing.evolve(lengths, [], 1, 60, individuals=8, generations=300)[0]
        assert packing.least_bins(lengths, 60) <= len(best) <= len(first)

    def test_islands_beat_best_fit_on_hard_lengths(self):
        """By one in a hundred bins, where best fit needs more than the lengths allow at least."""
        rng = random.Random(1)
        lengths = [rng.randint(700, 1500) for _ in range(2048)]
        first = packing.best_fit(lengths, list(range(len(lengths))), [], 4096)
        islands = [[], [], []]
        for epoch in range(packing.EPOCHS):
            guests = [[p[0]] if p else [] for p in islands[-1:] + islands[:-1]]
            islands = [packing.evolve(lengths, p + g, 10 * epoch + k, first=k == 0) for k, (p, g) in enumerate(zip(islands, guests))]
        assert min(len(p[0]) for p in islands) <= 0.99 * len(first)
        assert not any(p in islands[0] for p in islands[1])


def _der(tag, body):
    size = struct.pack("B", len(body)) if len(body) < 128 else b"\x82" + struct.pack(">H", len(body))
    return bytes([tag]) + size + body


PKCS1 = _der(0x30, _der(2, b"\0") + b"".join(_der(2, bytes(range(1, 65))) for _ in range(8)))
PKCS8 = _der(0x30, _der(2, b"\0") + _der(0x30, _der(6, b"\x2a\x86\x48") + _der(5, b"")) + _der(4, PKCS1))
SEC1 = _der(0x30, _der(2, b"\x01") + _der(4, bytes(32)))
SSH = b"openssh-key-v1\0" + b"".join(struct.pack(">I", len(x)) + x for x in (b"none", b"none", b"")) + struct.pack(">I", 1) + bytes(60)


def _url64(data):
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def _jwt(alg, signature):
    return ".".join([_url64(json.dumps({"alg": alg, "typ": "JWT"}).encode()), _url64(b'{"sub":"1234567890"}'), _url64(signature)])


class TestSecrets:
    @pytest.mark.parametrize(
        "kind, secret",
        [
            ("der", base64.b64encode(PKCS1).decode()),
            ("der", base64.b64encode(PKCS8).decode()),
            ("der", PKCS8.hex().upper()),
            ("der", base64.b64encode(SEC1).decode()),
            ("ssh", base64.b64encode(SSH).decode()),
            ("jwt", _jwt("HS256", bytes(32))),
            ("wrapped", base64.b64encode(b"login: me\npassword = correcthorse1").decode()),
            ("wrapped", b"password = correcthorse1".hex()),
            ("pem", "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(PKCS1).decode() + "-----END RSA PRIVATE KEY-----"),
        ],
    )
    def test_confirmed(self, kind, secret):
        text = f"é before {secret} after"
        assert (kind, 9, 9 + len(secret)) in secrets.confirmed_spans(text)
        assert secret not in secrets.masked(text, "[secret]")

    @pytest.mark.parametrize(
        "text",
        [
            base64.b64encode(PKCS1[:-3]).decode(),  # lengths don't add up
            base64.b64encode(_der(0x30, _der(2, b"\x07") + _der(4, bytes(40)))).decode(),  # no such version
            base64.b64encode(SSH[:20] + b"\xff" * 20).decode(),
            _jwt("HS256", bytes(31)),
            _jwt("XX99", bytes(32)),
            _url64(b"[1]" * 9) + ".eyJhIjoxfQ." + _url64(bytes(32)),
            base64.b64encode(b"nothing to see in this text at all").decode(),
            "-----BEGIN PRIVATE KEY-----\nAAAABBBBCCCC\n-----END PRIVATE KEY-----",
            "Antidisestablishmentarianism and honorificabilitudinitatibus",
        ],
    )
    def test_not_confirmed(self, text):
        assert secrets.confirmed_spans(f"x {text} y") == []

    @given(st.text(st.sampled_from("tokenTOKEN=: \"'aA1_-AKIA0f\n"), max_size=60))
    @short_settings
    def test_plain_kinds(self, text):
        got = secrets.plain_spans(text)
        assert sorted(got, key=lambda s: (s[1], secrets.KINDS.index(s[0]))) == plain.base_secrets(text)

    def test_only_ascii_letters_in_either_case(self):
        assert secrets.plain_spans("to\u212aen=abcdefgh") == secrets.plain_spans("\u017fecret=abcdefgh") == []
        assert secrets.plain_spans("API_KEY : 'abcdefgh'") == [("assign", 0, 19)]


class TestLicenses:
    def test_rules_are_many_and_gated(self):
        assert len(licenses.rules()) > 300
        for _, tier, keys, _ in licenses.rules():
            assert tier in licenses.TIERS and keys
            for key in keys:
                assert plain.words(key) == key.split(" ")

    @pytest.mark.parametrize(
        "text, labels",
        [
            ("Licensed under the Apache License, Version 2.0.", ["apache", "apache-2.0"]),
            ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0-or-later"]),
            ("Licensed under CC BY-NC-SA 4.0", ["cc-by", "cc-by-nc-sa"]),
            ("see https://www.gnu.org/licenses/gpl-3.0.html", ["gpl-3.0"]),
            ("Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software and associated documentation files", ["mit"]),
            ("available under the terms of the GNU Lesser General Public License, version 2.1", ["lgpl-2.1"]),
            ("GNU General Public License v3.0 and the MIT License", ["gpl", "gpl-3.0", "mit"]),
            ("the mit in german is no license", []),
            ("", []),
        ],
    )
    def test_labels(self, text, labels):
        found = licenses.scan(text.encode())
        assert found["labels"] == labels and 0 <= found["score"] <= 1 and (found["score"] > 0) == bool(labels)

    def test_offsets_and_suppression(self):
        text = "été — licensed under the MIT License!"
        (one,) = licenses.scan(text.encode())["detections"]
        assert (one["tier"], text[one["start"] : one["end"]], one["first"]) == ("statement", "licensed under the MIT License", 2)

    @given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 6), st.integers(0, 440)), max_size=12))
    @short_settings
    def test_suppression_by_brute_force(self, found):
        found = sorted({(a, a + n, r) for a, n, r in found})
        tier = [licenses.TIERS[t][0] for _, t, _, _ in licenses.rules()]

        def beaten(d):
            return any(
                o != d and o[0] <= d[0] and d[1] <= o[1] and (tier[o[2]] > tier[d[2]] or tier[o[2]] == tier[d[2]] and (o[:2] != d[:2] or o[2] < d[2])) for o in found
            )

        assert licenses.suppressed(found) == [d for d in found if not beaten(d)]

    @given(st.lists(st.sampled_from("gnu general public license apache cc by mit licensed under the x".split()), max_size=30))
    @short_settings
    def test_base_places(self, words):
        text = " - ".join(words)
        found = licenses.scan(text.encode())
        assert (found["n_words"], found["n_base"], found["first_word"], found["last_word"], ",".join(found["base_labels"])) == plain.licenses(text)


class TestDecontaminate:
    @given(st.lists(st.lists(st.sampled_from("abcd"), max_size=14), max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(2, 5))
    @short_settings
    def test_scan_by_brute_force(self, items, doc, window):
        rows = [(str(k), " ".join(w)) for k, w in enumerate(items)]
        n, runs, names = decontaminate.Scanner([(k, t.encode()) for k, t in rows], window).scan(" ".join(doc).encode())
        ((words, hit, found),) = plain.leaks([(0, " ".join(doc))], rows, window)
        assert (n, sum(b - a + 1 for a, b in runs), names) == (words, hit, found)

    def test_spans(self):
        text = "Ñandú, ¿une ünï (two)\tthree?"
        assert [text[a:b] for a, b in decontaminate.char_spans(text.encode(), [(0, 0), (2, 3)])] == ["Ñandú", "ünï (two"]


class TestQualityRules:
    @given(st.lists(st.sampled_from(["a", "b", "c", "\n"]), max_size=60))
    @short_settings
    def test_counts(self, parts):
        text = " ".join(parts)
        found = quality_rules.rules(text.encode(), lambda b: b)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(found[c] for c in names) == plain.quality(text)

    def test_equal_hashes_don_t_count_as_equal(self, monkeypatch):
        monkeypatch.setattr(quality_rules, "_MULTIPLIERS", np.zeros(8, np.uint64))
        words = [str(k % 11).encode() for k in range(40)] + [str(k).encode() for k in range(30)]
        assert quality_rules.repeated_words(words) == plain.quality(" ".join(w.decode() for w in words))[4] > 0

    def test_bands(self):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        rng = random.Random(1)
        prose = " ".join("".join(rng.choices("etaoinshr", k=rng.randint(2, 8))) for _ in range(4000))
        assert quality_rules.rules(prose.encode(), squeeze)["kept"]
        noise = base64.b85encode(rng.randbytes(20_000)).decode()
        noisy = " ".join(noise[k : k + 8] for k in range(0, len(noise), 8))
        assert not quality_rules.rules(noisy.encode(), squeeze)["kept"]
        lines = "".join(f"row {k} of the same old table\n" for k in range(2000))
        found = quality_rules.rules((prose + lines).encode(), squeeze)
        assert not found["kept"] and not found["base_failed"] and found["n_odd_chunks"] > 0


class TestNearDedup:
    def test_signatures_estimate_similarity(self):
        rng = random.Random(3)
        words = [f"w{rng.randint(0, 3000)}" for _ in range(400)] * 2
        rows = [words]
        for edits in (1, 4, 12, 30, 80):
            rows.append([f"z{rng.random()}" if k < edits else w for k, w in enumerate(words)])
        bodies = [" ".join(r).encode() for r in rows]
        owners, keys, weights = near_dedup.elements(*word_hashes(bodies))
        signatures = near_dedup.dart_signatures(owners, keys, weights, len(rows), 4000)
        for k in range(len(rows)):
            exact = near_dedup.similarity(bodies[0], bodies[k])
            assert abs((signatures[0] == signatures[k]).mean() - exact) < 0.03

    def test_real_weights(self):
        keys = np.arange(1, 201, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        a, b = np.linspace(0.2, 7, 200), np.linspace(0.2, 7, 200)[::-1]
        signatures = near_dedup.dart_signatures(np.repeat([0, 1], 200), np.tile(keys, 2), np.concatenate([a, b]), 2, 4000)
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((signatures[0] == signatures[1]).mean() - exact) < 0.03

    @given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), min_size=1, max_size=5))
    @short_settings
    def test_exact_similarity(self, rows):
        bodies = [" ".join(r).encode() for r in rows]
        keys, weights = near_dedup.shingles(bodies)
        near = near_dedup.ShingleIndex(list(zip(keys, weights))).similarities(keys[0], weights[0])
        for k, r in enumerate(rows):
            x, y = plain.shingles(" ".join(rows[0])), plain.shingles(" ".join(r))
            both = (x & y).total()
            expected = both / max(1, x.total() + y.total() - both)
            assert abs(near[k] - expected) < 1e-12 and abs(near_dedup.similarity(bodies[0], bodies[k]) - expected) < 1e-12


class TestLanguage:
    def test_tables_give_the_network_s_values(self):
        rng = np.random.default_rng(0)
        windows = rng.integers(0, 256, (40, 64)).astype(np.uint8)
        net = language.train(windows, np.arange(40) % 2, ["x", "y"], epochs=2)
        pooled = []
        for w, f, b in zip(language.WIDTHS, net.filters, net.bias):
            patches = np.stack([net.embedding[windows[:, j : windows.shape[1] - w + 1 + j]] for j in range(w)], axis=2)
            pooled.append(np.einsum("npje,jef->npf", patches, f).max(axis=1) + b)
        expected = language.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.out_bias)
        assert np.allclose(net.probabilities(windows), expected, atol=1e-4)

    def test_gradients(self):
        rng = np.random.default_rng(1)
        x, y = rng.integers(1, 256, (3, 20)).astype(np.uint8), np.array([0, 1, 1])
        net = language.train(x, y, ["x", "y"], epochs=1)
        weight = np.array([1.0, 0.5, 2.0])

        def loss():
            e = net.embedding[x]
            pooled = [
                np.einsum("npje,jef->npf", np.stack([e[:, j : 20 - w + 1 + j] for j in range(w)], axis=2), f).max(axis=1) + b
                for w, f, b in zip(language.WIDTHS, net.filters, net.bias)
            ]
            p = language.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.out_bias)
            return -(weight * np.log(p[np.arange(3), y])).mean()

        for p, g in zip(net.parameters(), language._gradients(net, x, y, weight)):
            at = np.unravel_index(np.abs(g).argmax(), g.shape)
            p[at] += 1e-6
            up = loss()
            p[at] -= 2e-6
            down = loss()
            p[at] += 1e-6
            assert abs((up - down) / 2e-6 - g[at]) < 1e-3 * max(1, abs(g[at]))

    def test_all_windows(self):
        windows, owner, sizes = language.windows_of([b"a" * 600, b"", b"B" * 256])
        assert owner.tolist() == [0, 0, 0, 1, 2] and sizes.tolist() == [256, 256, 88, 1, 256] and bytes(windows[4]) == b"b" * 256


class TestQualityModel:
    def test_estimation_finds_accuracies(self):
        rng = np.random.default_rng(5)
        good = rng.random(20_000) < 0.8
        right = np.array([[0.7, 0.5, 0.9, 0.4], [0.95, 0.99, 0.9, 0.97]])
        votes = np.where(rng.random((20_000, 4)) < right[good.astype(int)], good[:, None], ~good[:, None]).astype(int)
        votes[rng.random(votes.shape) < 0.1] = -1
        patterns, counts = np.unique(votes, axis=0, return_counts=True)
        prior, found = quality_model.estimate(patterns, counts.astype(float), 200)
        assert abs(prior - 0.8) < 0.06 and np.abs(found - right).max() < 0.12
        said = quality_model.posterior(votes, prior, found) >= 0.5
        assert (said == good).mean() > 0.9

    def test_scorer_learns(self):
        rng = np.random.default_rng(2)
        places = [rng.choice(1000, 20, replace=False) for _ in range(400)]
        target = np.array([float((p < 100).sum() > 1) for p in places])
        scorer = quality_model.Scorer().train(places, [np.ones(20)] * 400, target, epochs=20)
        said = np.array([scorer.weights[p].sum() + scorer.bias > 0 for p in places])
        assert (said == target).mean() > 0.95

    def test_votes_of_odd_texts(self):
        for text in (None, b"", b"x", b"\n\n", b"a " * 5000, "🙂".encode() * 300):
            votes = quality_model.votes_of(text)
            assert len(votes) == len(quality_model.ALL) and set(votes) <= {-1, 0, 1}


class TestSuffixTree:
    @given(st.lists(st.lists(st.integers(2, 5), max_size=12), min_size=1, max_size=6))
    @short_settings
    def test_scores_by_brute_force(self, rows):
        stream = np.array([s for r in rows for s in [*r, 0]], np.int64)
        counts = np.bincount(stream, minlength=6).astype(float)
        levels, candidates = [], np.flatnonzero(counts)
        for d in (1, 2, 3):
            keys, n = suffix_tree.followers(stream, d, candidates)
            context, symbol = candidates[keys >> 12], keys & 4095
            levels.append((context, symbol, n.astype(float)))
            candidates = np.sort((context << 12 | symbol)[symbol != 0])
        tree = suffix_tree.build(counts + 1, levels)
        # The same with dictionaries.
        after = {}
        for r in rows:
            s = [0, *r, 0]
            for k in range(1, len(s)):
                for d in range(1, min(3, k) + 1):
                    after.setdefault(tuple(s[k - d : k]), {}).setdefault(s[k], 0)
                    after[tuple(s[k - d : k])][s[k]] += 1

        def dist(context):
            if not context:
                return (counts + 1) / (counts + 1).sum()
            own = np.zeros(6)
            for s, n in after[context].items():
                own[s] = n
            kinds = len(after[context])
            return (own + kinds * dist(context[1:])) / (own.sum() + kinds)

        retained = set()
        for context, seen in after.items():
            total, above = sum(seen.values()), dist(context[1:])
            if sum(n * np.log(n / total / above[s]) for s, n in seen.items()) > len(seen):
                retained |= {context[k:] for k in range(len(context))}
        expected = []
        for r in rows:
            s = [0, *r, 0]
            for k in range(1, len(s)):
                context = ()
                for d in range(1, min(3, k) + 1):
                    if tuple(s[k - d : k]) in retained:
                        context = tuple(s[k - d : k])
                    else:
                        break
                expected.append(np.log10(dist(context)[s[k]]))
        assert np.allclose(tree.score(stream, step=5), expected)

    def test_symbol_masses(self):
        symbols = suffix_tree.choose_symbols([(7, 100, 50)], [(100, 3, 58), (101, 2, 40), (102, 1, 1)], 10, 5)
        assert symbols.words.tolist() == [7] and symbols.shapes.tolist() == [100, 101]
        assert symbols.counts.tolist() == [10, 1, 50, 8, 40] and symbols.mass.tolist() == [11, 3, 51, 11, 43]
