"""The parts that need no Spark, against brute force and round trips."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kerfline.llm import blocks, decontam, gif, jaccard, langid, packing, quality, repeats, spandedup
from kerfline.llm.queries import token_path


@pytest.mark.parametrize("seed", range(20))
def test_run_length_index(seed):
    """Matching statistics over parts: exact wherever a match of `length` decides, and streamed from few samples."""
    rng = random.Random(seed)
    length = rng.choice([1, 3, 8])
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 6))]
    if seed % 2:
        parts += [parts[0] + b"a", b"ab" * 40]
    weights = np.array([rng.choice([1, 1, 2]) for _ in parts])
    places = [(p, i) for p, x in enumerate(parts) for i in range(len(x) - length + 1)]

    def lcp(a, b):
        x, y = parts[a[0]][a[1] :], parts[b[0]][b[1] :]
        return next((k for k, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))

    index = repeats.RunLengthIndex(parts, weights, length)
    want = [max([lcp(a, b) for b in places if b != a] + [len(parts[a[0]]) - a[1] if weights[a[0]] > 1 else 0]) for a in places]
    got = index.matching_statistics()
    assert [(p, i) for p, i in zip(index.part, index.at)] == places
    assert [g if g >= length else 0 for g in got.tolist()] == [w if w >= length else 0 for w in want]
    assert all(g >= w for g, w in zip(got.tolist(), want)) and index.runs <= len(places)
    marked = {(p, i) for p, a, b in zip(*repeats.mark_windows(parts, weights, length)) for i in range(a, b + 1)}
    assert marked == {place for place, w in zip(places, want) if w >= length}


def test_run_length_index_compresses():
    """Repetitive parts have far fewer runs than places."""
    base = bytes(random.Random(1).choice(b"acgt") for _ in range(300))
    parts = [base[:k] + b"x" + base[k:] for k in range(40)]
    index = repeats.RunLengthIndex(parts, np.ones(40), 50)
    assert index.runs * 4 < index.size


@pytest.mark.parametrize("data", [b"", b"a" * 5000, bytes(range(256)) * 40, np.random.default_rng(1).integers(0, 256, 30000, np.uint8).tobytes()])
def test_lzw_round_trip(data):
    assert gif.lzw_decode(gif.pack(*gif.lzw_codes(data)), 8) == data


def test_gif_frames_disposal_and_transparency():
    payload = np.random.default_rng(2).integers(0, 256, 64 * 2500, np.uint8).tobytes()
    got, frames = gif.read_back(gif.encode(payload))
    assert got == payload and [(f["index"], f["at_ms"], f["height"]) for f in frames] == [(0, 0, 1024), (1, 40, 1024), (2, 80, 452)]
    # the last frame covers the upper part of the picture, below which the one before stays
    shown = payload[64 * 2048 :] + payload[64 * 1476 : 64 * 2048]
    colours = np.frombuffer(gif.PALETTE, np.uint8).reshape(-1, 3)[np.frombuffer(shown, np.uint8)] >> 6
    want = collections.Counter((colours.astype(int) @ [16, 4, 1]).tolist())
    assert len(set(gif.PALETTE[i : i + 3] for i in range(0, 768, 3))) == 256 and {c["colour"]: c["pixels"] for c in frames[2]["colours"]} == want
    # two frames by hand: the second has a transparent pixel and shows the first through it
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    one, two = gif.pack(np.array([4, 1, 1, 5]), np.array([3, 3, 3, 3])), gif.pack(np.array([4, 2, 0, 5]), np.array([3, 3, 3, 3]))

    def frame(data, disposal, transparent):
        return b"\x21\xf9\x04" + bytes([disposal << 2 | (transparent is not None), 5, 0, transparent or 0]) + b"\0" + b"\x2c" + bytes([0, 0, 0, 0, 2, 0, 1, 0, 0]) + b"\x02" + bytes([len(data)]) + data + b"\0"

    for disposal, behind in ((1, [255, 0, 0, 255]), (2, [0, 0, 0, 0]), (3, [0, 0, 0, 0])):
        media = b"GIF89a" + bytes([2, 0, 1, 0, 0x81, 0, 0]) + palette + frame(one, disposal, None) + frame(two, 1, 0) + b"\x3b"
        shown = [(f.rgba()[0].tolist(), f.at, f.delay) for f in gif.decode(media)]
        assert shown == [([[255, 0, 0, 255]] * 2, 0, 5), ([[0, 255, 0, 255], behind], 5, 5)]


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(3)
    sizes = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    room, want = [], []
    for s in sizes:
        k = next((i for i, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(100)
        room[k] -= s
        want.append(k)
    assert packing.first_fit_decreasing(sizes, 100) == want


def test_cached_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    texts = ["", "It's  42 DAYS in Zürich, don't!\n\n", "a\x1cb\x85c <|endoftext|>x", "É́ ΣΑΣ 12.5%", "word " * 300, "x<|endoftext|>. (a) \"b\" c'S d***e İi. ſ, ŉ; e\u0301, é,\u0301", "".join(random.Random(5).choice("abZ09 .,'-_<|\n\xa0éßİ\u0301ΣЙ") for _ in range(20000))]
    got = packing.CachedTokenizer(token_path(), limit=3).encode(texts)
    plain = Tokenizer.from_file(token_path())
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_banded_alignment_finds_edits():
    item = "The quick brown fox jumps over the lazy dog while seven wizards quietly boil green jam in the old harbour town today."
    near = item.replace("quick", "quack").replace("green ", "")
    index = decontam.BenchmarkIndex([7, 8, 9], [item, "short", None], 0.1)
    doc, which, edits = index.search(pa.array([None, "", "Intro. " + item.upper() + " Outro", "x " + near + " y", "nothing of the kind here, " * 9, item[: len(item) // 2]]))
    assert doc.tolist() == [2, 3] and [index.ids[i] for i in which] == [7, 7] and edits[0] == 0 and 0 < edits[1] <= index.budget[0]


def test_shingles_against_sets():
    texts = [None, "", " \t", "One", "a b c", "a b c d a b c d a b", "A b\nc  d"]
    first, x = jaccard.shingles(pa.array(texts), 4)
    want = []
    for t in texts:
        w = (t or "").lower().split()
        want.append(len({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()))
    assert np.diff(first).tolist() == want
    assert x[first[5]] in set(x[first[5] : first[6]]) and x[first[6]] in set(x[first[5] : first[6]])


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(4)
    lines = np.array([3, 1, 4])
    unary, move = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    good, _, z = quality.marginals(unary, move, lines)
    at = 0
    for k, n in enumerate(lines):
        weights, mass = {}, np.zeros(n)
        for bits in range(1 << n):
            y = [bits >> i & 1 for i in range(n)]
            w = np.exp(sum(unary[at + i, y[i]] for i in range(n)) + sum(move[y[i], y[i + 1]] for i in range(n - 1)))
            weights[bits] = w
            mass += w * np.array(y)
        total = sum(weights.values())
        assert np.allclose(good[at : at + n], mass / total) and np.isclose(z[k], np.log(total))
        at += n


def test_blocks_and_sentences():
    data, starts, ends = blocks.separated(pa.array(["One. Two! Three?\nFour", None, "x.y z."]))
    b, e, d = spandedup.sentences(data, starts, ends)
    assert [data[i:j].tobytes() for i, j in zip(b, e)] == [b"One. ", b"Two! ", b"Three?\n", b"Four", b"x.y z."] and d.tolist() == [0, 0, 0, 0, 2]
    h, owner, letters = langid.grams(pa.array(["Ab 1", None]))
    assert letters.tolist() == [2, 0]


def fewest_edits(item, text):
    """Of any part of text, by the whole table of alignment."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def folded(text):
    return re.sub("[\x00-/:-@\\[-`{-\x7f]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).strip(" ")


@pytest.mark.parametrize("seed", range(6))
def test_edits_against_whole_alignment(seed, monkeypatch):
    """Every item within its budget is found with its fewest edits, counted in characters, and no other."""
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(decontam, "STEP", 700)
    letters = "abc é" if seed < 3 else "aab"
    items = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 70))) for _ in range(6)] + [None, "", "Ünïcödé is öne chäracter each, not twö", "a" * 40]

    def edited(x):
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(x) + 1)
            x = x[:at] + rng.choice(["", "é", "b"]) + x[at + rng.randint(0, 1) :]
        return x

    texts = [" ".join(edited(rng.choice(items) or "x") for _ in range(rng.randint(1, 3))) for _ in range(30)] + [None, "", "a" * 300, " A-B!c  " * 9, items[8].upper(), "x" + items[8].replace("ö", "o")]
    index = decontam.BenchmarkIndex(list(range(len(items))), items, 0.15)
    budget = {i: int(index.budget[k]) for k, i in enumerate(index.ids)}
    assert set(budget) == {i for i, x in enumerate(items) if len(folded(x)) >= decontam.Q}
    want = {(t, i, e) for t, x in enumerate(texts) for i, k in budget.items() if (e := fewest_edits(folded(items[i]), folded(x))) <= k}
    doc, item, edits = index.search(pa.array(texts, pa.string()))
    assert {(t, index.ids[i], e) for t, i, e in zip(doc.tolist(), item.tolist(), edits.tolist())} == want and len(want) > 5
