"""Operators 6 and 10: the work that a block of texts, a part of words and a round of Re-Pair take, and that it is right."""

import random
import re
from array import array
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa

from meshlark.llm import _pieces, bpe, repair


def words_of(block):
    """The words of each text, in order."""
    ends, words, at = block.ends.tolist(), block.words.to_pylist(), 0
    out = []
    for n in block.n_places.tolist():
        out.append([words[w] for p in block.places[at : at + n].tolist() for w in block.flat[ends[p - 1] if p else 0 : ends[p]].tolist()])
        at += n
    return out


def test_words_of_letters_need_no_pattern(monkeypatch):
    plain, asked = _pieces.pc.extract_regex, []
    monkeypatch.setattr(_pieces.pc, "extract_regex", lambda strings, *a, **b: asked.extend(strings.to_pylist()) or plain(strings, *a, **b))
    texts = ["Alpha beta gamma", "beta, gamma beta's é\nx 12 @[`{ AZaz", None, "", "don't 'll it 'd"]
    split = _pieces.splitter(P.PATTERN)
    block = _pieces.cut(pa.array(texts), split)
    assert words_of(block) == [split(t or "") for t in texts]
    assert len(set(block.words.to_pylist())) == len(block.words)
    assert {"beta,", "beta's", "12", "@[`{"} <= set(asked) and not [p for p in asked if re.fullmatch("[A-Za-z]+", p)]


def test_words_are_dealt_by_ranges_of_hash():
    words = pa.array([b"", b"a", b"ab", b"ba", "é".encode(), b"x" * 5000, *(b"w%d" % k for k in range(4000))], pa.large_binary())
    sizes, rest = bpe._parted(words.slice(1))
    assert bpe._joined(sizes, rest).equals(words.slice(1)) and b"".join(words.to_pylist()) == rest
    h = bpe._hashes(*bpe._parted(words))
    assert h[1:].tolist() == bpe._hashes(sizes, rest).tolist() and bpe._hashes(*bpe._parted(words.slice(5, 1))).tolist() == h[5:6].tolist()
    order = np.argsort(h, kind="stable")
    cuts = bpe._dealt(*bpe._parted(words.take(pa.array(order))), 7)
    assert cuts[0] == 0 and cuts[-1] == len(words) and min(np.diff(cuts)) > 400
    again, same = bpe.sizes_and_rest(bpe.pack(*bpe._parted(words)))
    assert bpe._joined(again, same).equals(words) and len(bpe._hashes(*bpe._parted(words.slice(0, 0)))) == 0


def test_a_part_is_encoded_at_once(spark, monkeypatch):
    from types import SimpleNamespace

    calls = []

    def coder(library, data, pattern):
        return lambda words: (calls.append(words.to_pylist()), (np.array([len(w) for w in words.to_pylist() for _ in w], "<u4"), np.array([len(w) for w in words.to_pylist()])))[1]

    monkeypatch.setattr(bpe, "word_coder", coder)
    asked = [(3, "b1", [b"a", b"bcd"]), (3, "b2", [b"bcd", b"ef"]), (4, "b1", [b"ef"])]
    data = [bpe.pack(*bpe._parted(pa.array(w, pa.large_binary()))) for *_, w in asked]
    batch = pa.RecordBatch.from_arrays([pa.array([p for p, *_ in asked], pa.int32()), pa.array([b for _, b, _ in asked]), pa.array(data, pa.binary())], names=["part", "block", "data"])
    for most, want in ((1 << 20, [[b"a", b"bcd", b"ef"], [b"ef"]]), (1, [[b"a", b"bcd"], [b"bcd", b"ef"], [b"ef"]])):
        calls.clear()
        monkeypatch.setattr(bpe, "PART_BYTES", most)
        found = list(bpe._answer(f"none {most}", SimpleNamespace(value=b""), "")(iter([batch])))
        assert calls == want  # a part's words once, however many blocks ask for them
        assert [(b["part"][0].as_py(), b["block"][0].as_py()) for b in found] == [(p, b) for p, b, _ in asked]
        for (*_, words), b in zip(asked, found, strict=True):
            sizes, ids = bpe.sizes_and_rest(b["data"][0].as_py())
            assert sizes.tolist() == [4 * len(w) for w in words] and ids == b"".join(array("I", [len(w)] * len(w)).tobytes() for w in words)


def test_ids_of_words_are_the_library_s():
    from tokenizers import Tokenizer, models, pre_tokenizers

    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    words = [" hello", "<|endoftext|>", "\n\n", " ", " żółw", "😀😀", " Anblewh", "'ll", "x" * 900, *(f" {k}w{k % 7}" for k in range(9000))]
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        ids, n = bpe.word_coder("tokenizers", f.read(), P.PATTERN)(pa.array([w.encode() for w in words], pa.large_binary()))
    want = [tk.encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == [i for x in want for i in x] and n.tolist() == [len(x) for x in want]
    few = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2}, [("a", "b")]))  # bytes that it does not know are left out
    few.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    coder = bpe.word_coder("tokenizers", few.to_str().encode(), P.PATTERN)
    ids, n = coder(pa.array([b"ab", b"xyz", b"bxa"], pa.large_binary()))
    assert ids.tolist() == [2, 1, 0] and n.tolist() == [1, 0, 2]
    assert [x.tolist() for x in coder(pa.array([], pa.large_binary()))] == [[], []]


def rounds_of_repair(ids, end, base, least):
    """Re-Pair round by round, place by place."""
    s, rules = list(ids), []
    while True:
        places, last = {}, -2
        for i in range(len(s) - 1):
            if end not in s[i : i + 2] and not (i == last + 1 and s[i - 1] == s[i] == s[i + 1]):
                places[i], last = (s[i], s[i + 1]), i
        n = Counter(places.values())
        rank = {p: k for k, p in enumerate(sorted((p for p in n if n[p] >= least), key=lambda p: (-n[p], p)))}
        if not rank:
            return s, rules
        own = {i: rank[p] for i, p in places.items() if p in rank}
        first = [i for i, k in own.items() if k < own.get(i - 1, 1 << 30) and k < own.get(i + 1, 1 << 30)]
        n = Counter(places[i] for i in first)
        chosen = {p: base + len(rules) + k for k, p in enumerate(sorted(p for p in n if n[p] >= least))}
        for i in reversed(first):
            if places[i] in chosen:
                s[i : i + 2] = [chosen[places[i]]]
        rules += chosen


def test_rounds_of_repair():
    r = random.Random(4)
    for k in range(60):
        base = r.choice([20, 65_530, 65_535, 65_536, 70_000])
        ids = [r.choice([2, 5, 6, 7, 7, base - 1]) for _ in range(r.randint(0, 500))]
        symbols, rules = repair.compress(np.array(ids, np.int64), 2, base, least=r.randint(2, 5) if k % 2 else 3)
        lengths = repair.expansion_lengths(rules, base)
        assert repair.expand(symbols, rules, lengths, base).tolist() == ids
        if k % 2 == 0:
            want, by = rounds_of_repair(ids, 2, base, 3)
            assert symbols.tolist() == want and [tuple(x) for x in rules.tolist()] == by


def test_pairs_are_looked_up_exactly():
    r = np.random.default_rng(5)
    for kind in (np.uint32, np.uint64):
        none = np.iinfo(kind).max
        for n in (1, 3, 5000):
            pairs = np.unique(r.integers(0, none, n, dtype=kind))
            keys = np.concatenate([pairs, r.integers(0, none, 20_000, dtype=kind), pairs + kind(1), np.array([none], kind)])
            place = {p: k for k, p in enumerate(pairs.tolist())}
            assert repair._places(keys, pairs, none).tolist() == [place.get(x, len(pairs)) for x in keys.tolist()]
