"""Array kernels against plain Python."""

import random
import re
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketspark.llm import bloom_lm, factor_machine, kdtree, langid, mixing, packing, partenum, text

WORDS = re.compile(text.WORD)
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abÀé中 \n\t\x0b\r.,'|<1", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_of_slices(texts):
    seen = {}
    for part in text.slices(pa.array(texts, pa.string()), limit=20):
        starts, ends, first = part.words()
        raw = part.data.tobytes()
        hashes = part.hashes(starts, ends)
        for k, row in enumerate(part.rows):
            own = [raw[a:b].decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
            assert own == WORDS.findall(texts[row] or "")
            for w, h in zip(own, hashes[first[k] : first[k + 1]]):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_case_is_ascii_only():
    (part,) = text.slices(pa.array(["ABC É abc é"]))
    starts, ends, _ = part.words()
    h = part.hashes(starts, ends, lower=True)
    assert h[0] == h[2] and h[1] != h[3]


def test_slices_of_a_sliced_array():
    rows = pa.array(["zero", None, "two", "", "four five"]).slice(1)
    got = [(row, part.data[part.bounds[k] : part.bounds[k + 1]].tobytes()) for part in text.slices(rows, 3) for k, row in enumerate(part.rows)]
    assert got == [(0, b""), (1, b"two"), (2, b""), (3, b"four five")]


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = partenum.Bands(Fraction(percent, 100))
    linked = 0
    frequent = np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64))
    rank = rng.permutation(len(frequent))
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        a = np.concatenate([a[: int(rng.integers(0, n + 1))], rng.choice(frequent, int(rng.integers(0, 60)), replace=False), a[-1:]])
        n = len(a)
        lost, new = int(rng.integers(0, n // 6 + 2)), int(rng.integers(0, n // 6 + 2))
        b = np.concatenate([a[lost:], rng.integers(0, 1 << 62, new).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
            linked += 1
            same = len(a) == len(b) == common
            assert same or len(np.intersect1d(partenum.signatures(a, bands, frequent, rank), partenum.signatures(b, bands, frequent, rank)))
    assert linked > 50


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    size = factor_machine.WORD_BUCKETS + len(factor_machine.STATISTICS)
    m = factor_machine.Machine(rng.normal(size=size), rng.normal(size=(size, 4)))
    row, at, x = np.array([0, 0, 0]), np.array([3, 70, 9000]), np.array([0.5, 1.0, -2.0])
    stats = rng.normal(size=(2, len(factor_machine.STATISTICS)))
    dense = np.zeros((2, size))
    dense[0, at] = x
    dense[:, factor_machine.WORD_BUCKETS :] = stats
    some = [np.flatnonzero(d) for d in dense]
    want = [
        d @ m.w + sum(d[i] * d[j] * (m.v[i] @ m.v[j]) for p, i in enumerate(s) for j in s[p + 1 :]) for d, s in zip(dense, some)
    ]
    assert np.allclose(m.raw(row, at, x, stats)[0], want)


def test_encoder_equals_the_tokenizer_on_any_text():
    encode, rng = packing.encoder(), random.Random(4)
    parts = ["a", "é", " ", "\n", "\t", "　", ".", ",", "'s", "1", "The", "ß", "|", "<|endoftext|>", "!", "\x85", "中", "  ", "don't", "᠎", "x́", "\x1c"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert encode.ids(t) == encode.whole(t), repr(t)
    small = packing.Encoder(public_tokenizers.path(packing.TOKENIZER), limit=3)
    assert small.ids("one two three four five one") == encode.whole("one two three four five one")


def test_best_fit_places_pieces_without_overlap():
    rng, packer, used = random.Random(2), packing.BestFit(100, 4), {}
    for _ in range(500):
        n = rng.randint(1, 100)
        at, offset = packer.place(n)
        assert offset == used.get(at, 0)
        used[at] = offset + n
        assert packer.opened <= 4 and used[at] <= 100


def test_the_fullest_sequence_closes():
    packer = packing.BestFit(10, 2)
    assert [packer.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2]  # 1 held more than 0
    packer = packing.BestFit(10, 2)
    for n in (6, 7, 9):
        packer.place(n)
    assert packer.place(4) == (0, 6)


def test_pieces():
    assert packing.pieces_of(5, 10) == [(0, 5)] and packing.pieces_of(10, 10) == [(0, 10)]
    assert packing.pieces_of(23, 10) == [(0, 3), (3, 10), (13, 10)] and packing.pieces_of(20, 10) == [(0, 10), (10, 10)]


def test_tree_search_equals_brute_force():
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (700, 5)).astype(float)
    x[100:300] = x[0]
    ids = rng.permutation(700)
    tree = kdtree.Tree(ids, x, leaf=16)
    for q in range(0, 700, 23):
        bound = tree.bounds(x[q : q + 1])[0]
        got = tree.search(ids[q], x[q], bound, 5, float("-inf"), 2**63 - 1)
        want = sorted(((-(x[i] @ x[q]), ids[i]) for i in range(700) if ids[i] != ids[q]))[:5]
        assert got == [(-s, i) for s, i in want]


def test_targets_and_flow():
    sizes = {"a": 10, "b": 1000, None: 1000}
    got = mixing.targets(sizes, mixing.cycled_weights(sizes))
    assert got["a"] == 30 and got[None] / got["b"] == pytest.approx(3 / 2) and sum(got.values()) == pytest.approx(2010)
    # Pattern 1 may go to either quota; repeating it costs, so quota 0 is met from pattern 0 first.
    assert mixing.min_cost_flow([10, 10], [[0], [0, 1]], [12, 8]) == [[10], [2, 8]]
    assert mixing.min_cost_flow([10], [[0]], [100]) == [[30]]
    assert mixing.min_cost_flow([], [], []) == []


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    n = rng.integers(1, 3000, 4000)
    f = bloom_lm.Filter(bloom_lm.MIN_BITS)
    seg = bloom_lm._segment(h)
    for s in np.unique(seg):
        f.add(s, h[seg == s], bloom_lm.quantise(n[seg == s]))
    level = f.level(h)
    assert (level >= bloom_lm.quantise(n)).all() and (level == bloom_lm.quantise(n)).mean() > 0.9
    assert (f.level(rng.integers(0, 1 << 63, 4000).astype(np.uint64)) == 0).mean() > 0.9


@pytest.mark.parametrize("n", [1000, 300000])
def test_filter_keeps_its_false_positive_rate(n):
    rng = np.random.default_rng(7)
    h = rng.integers(0, 1 << 63, n).astype(np.uint64)
    f = bloom_lm.Filter.for_entries(n)
    f.add(0, h, np.ones(n, np.int64))
    other = rng.integers(0, 1 << 63, 50000).astype(np.uint64)
    assert (f.level(other, np.zeros(50000, np.int64)) > 0).mean() < 1.3 * bloom_lm.FALSE_POSITIVES


def test_counts_survive_their_parts():
    rng = np.random.default_rng(8)
    h = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    n = rng.integers(1, 1 << 40, len(h))
    batch = bloom_lm._parts(h, n, 512)
    back = {int(x): int(y) for g, c in zip(batch.column("gaps").to_pylist(), batch.column("n").to_pylist())
            for x, y in zip(np.cumsum(bloom_lm._numbers(g)), bloom_lm._numbers(c, np.int64))}
    assert back == dict(zip(h.tolist(), n.tolist()))


def test_mixture_finds_both_languages():
    rng = np.random.default_rng(6)
    log_p = np.log(rng.dirichlet(np.full(500, 0.1), 3) + 1e-9)
    draw = lambda g, k: rng.choice(500, k, p=np.exp(log_p[g]) / np.exp(log_p[g]).sum())
    theta, chosen = langid.identify(log_p, np.concatenate([draw(0, 3000), draw(2, 1000)]))
    assert sorted(chosen) == [0, 2] and theta[0] == pytest.approx(0.75, abs=0.05)
    assert langid.identify(log_p, draw(1, 2000))[1] == [1]


def test_scores_ask_once_for_words_and_once_for_bigrams():
    """Without a vocabulary every word before is a word, so its level is asked for once; what is asked for is distinct and sorted."""
    rng = np.random.default_rng(3)
    end = np.array([bloom_lm.END], np.int64).view(np.uint64)
    tokens = np.concatenate([np.concatenate([text.mix(rng.integers(0, 50, n).astype(np.uint64)), end]) for n in (0, 40, 7, 0, 300)])
    model = {"n": 10_000, "types": 60, "vocabulary": None}
    before = np.concatenate([end, tokens[:-1]])
    want = np.unique(np.concatenate([tokens, bloom_lm._bigrams(before, tokens)]) & bloom_lm._KEPT)
    np.testing.assert_array_equal(bloom_lm._asked(model, tokens), want)
    np.testing.assert_array_equal(bloom_lm._distinct(tokens[:0]), tokens[:0])
    calls = []

    def level(h):
        calls.append(h)
        return 1 + (h >> np.uint64(60)).astype(np.int64) % 4

    got = bloom_lm._scores(model, level, tokens)
    assert len(calls) == 2
    count = lambda h: bloom_lm.expected(level(h & bloom_lm._KEPT))
    p = (count(tokens) + bloom_lm.ADD) / (model["n"] + bloom_lm.ADD * 61)
    linked = np.minimum(1.0, count(bloom_lm._bigrams(before, tokens)) / count(before))
    np.testing.assert_allclose(got, np.log10(bloom_lm.LAMBDA * linked + (1 - bloom_lm.LAMBDA) * p))


def test_marks_and_one_newline_are_cut_off_new_words(monkeypatch):
    """Ids are those of the whole text; a new word costs no call of the pre-tokeniser for its marks or the newline before it."""
    import public_tokenizers

    encode = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    plain = encode.tokenizer
    texts = ["\nqworple qworple%%% Ünx#$*\nÜnx a;: b!? c&.", "\n\nqworple\n \nx'll! don't% 's. 12%\n12# x̀! ǅ: a b%", "\n", "!", " %", "\n%a", "a<|im_end|>% |>.", "\n᠎a."]
    for t in texts:
        assert encode.ids(t) == np.array(plain.encode(t, add_special_tokens=False).ids, np.uint32).tobytes(), t
    calls = []
    whole = packing.Encoder.whole
    monkeypatch.setattr(packing.Encoder, "whole", lambda self, chunk: calls.append(chunk) or whole(self, chunk))
    fresh = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    fresh.ids("\nqworple%%% zorbel%%%\nzorbel qworple")
    assert sorted(calls) == ["\n", "%%%"]
