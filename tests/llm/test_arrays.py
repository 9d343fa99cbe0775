"""The parts that need no Spark session, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from threadloom.llm import codes, disclosure, lines, packing, similar, words as W
from threadloom.llm.tokens import Encoder

ALPHABET = ["a", "B", "é", " ", " ", "\n", ".", ",", "'s", "1", "ß", "\t", "\r", "tion", "…", "\x1c", "😀", "!", "Σ", "\xa0", "\u2003", "␞"]


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cut_texts_have_the_ids_of_the_whole(name, spaced):
    own, plain = Encoder(public_tokenizers.path(name), spaced), Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    random.seed(3)
    texts = [None, "", " ", "a  b   c", " lead", "trail ", "don't <|endoftext|> x", "word. " * 2000]
    texts += ["".join(random.choices(ALPHABET, k=random.randint(0, 14))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_plain_words_go_to_the_model_alone(name, spaced):
    own, plain = Encoder(public_tokenizers.path(name), spaced), Tokenizer.from_file(public_tokenizers.path(name))
    random.seed(4)
    letters = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c) not in "ªµº"]
    words = ["".join(random.choices(letters, k=random.randint(1, 12))) for _ in range(400)] + ["the", "The", "THE"] + letters
    through = []
    own._plain = lambda text: through.append(text) or plain.encode(text, add_special_tokens=False).ids
    asked = [own.lead + word for word in words] + words
    own._encode_parts(asked)
    assert not through and all(own.simple(part) for part in asked)
    for part in asked:
        assert np.frombuffer(own.parts[part], "<u4").tolist() == plain.encode(part, add_special_tokens=False).ids, part
    texts = [" ".join(words), " ".join(words[::-1]) + ",\n" + words[0], "é", "aﬁ Ǆ İ ſ K Å"]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("top", [3, 300, 70_000, 1 << 25])
def test_codes_give_any_token(top):
    ids = np.random.default_rng(1).integers(0, top, 3000).astype(np.uint32)
    starts = np.array([0, 0, 1, 700, 3000])
    file = codes.CodeFile(b"".join(codes.pack_file([4, None, 7, 7], starts, ids)))
    assert file.tokens(0, 3000).tolist() == ids.tolist()
    assert [file.token(i) for i in range(0, 3000, 37)] == ids[::37].tolist()
    assert file.tokens(1234, 2345).tolist() == ids[1234:2345].tolist()
    assert [len(file.document(k)) for k in range(4)] == [0, 1, 699, 2300]
    assert file.doc_nulls.tolist() == [0, 1, 0, 0]
    with pytest.raises(IndexError):
        file.token(3000)


def test_code_file_without_documents():
    file = codes.CodeFile(b"".join(codes.pack_file([], np.array([0]), np.zeros(0, np.uint32))))
    assert file.tokens_total == 0 and file.tokens(0, 0).tolist() == []


def test_words_of_batches():
    texts = ["Ab cd", None, "", "x", "  y\tz  ", "é " * 3]
    got = []
    for row, data, offsets in W.slices(pa.array(texts), size=4):
        low = W.lower_ascii(data)
        starts, ends, owner = W.spans(low, offsets, W.NON_SPACE)
        got += [(row + o, low[a:b].tobytes().decode()) for a, b, o in zip(starts, ends, owner)]
    assert got == [(0, "ab"), (0, "cd"), (3, "x"), (4, "y"), (4, "z"), (5, "é"), (5, "é"), (5, "é")]


def test_span_hashes_depend_on_bytes_only():
    data = np.frombuffer(b"abc abd abc bc", dtype=np.uint8)
    h = W.span_hashes(data, np.array([0, 4, 8, 12]), np.array([3, 7, 11, 14]))
    assert h[0] == h[2] and len(set(h.tolist())) == 3
    assert W.span_hashes(data, np.array([1]), np.array([3]))[0] == h[3]


def _base_by_pattern(text: str) -> list[tuple[str, int, int]]:
    found = []
    for rank, (kind, pattern) in enumerate(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
        ]
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(doubled) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_patterns_against_plain_expressions():
    random.seed(5)
    parts = ["a", "@", ".", " ", "1", "25", "+", "-", "(", "b.c", "@x.y", "4539578763621486", "é", "999", "%", "0"]
    for _ in range(15_000):
        text = "".join(random.choices(parts, k=random.randint(0, 25)))
        assert disclosure.base_spans(text) == _base_by_pattern(text), text


def test_patterns_on_long_runs():
    assert disclosure.base_spans("1" * 200_000) == []
    assert disclosure.base_spans("a" * 200_000 + "@") == []
    assert disclosure.base_spans("a@" * 50_000) == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(0)
    tested = 0
    for _ in range(4000):
        size = int(np.exp(rng.uniform(np.log(4), np.log(700))))
        base = rng.integers(1, 1 << 63, size=size, dtype=np.uint64)
        cut = rng.permutation(base)[: size - rng.integers(0, size // 6 + 1)]
        a, b = np.unique(base), np.unique(np.concatenate([cut, rng.integers(1, 1 << 63, size=rng.integers(0, size // 6 + 2), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * len(np.union1d(a, b)) or both == len(a) == len(b):
            continue
        own, found = similar.signatures(np.array([len(a), len(b)]), np.concatenate([a, b]))
        assert len(np.intersect1d(found[own == 0], found[own == 1]))
        tested += 1
    assert tested > 2000


def test_shortest_windows_cover_the_runs():
    text = "\n".join(["w " * 30, "", "w " * 30, "x", "y " * 60])
    _, counts, (number, _, _, until, since) = next(lines._lines_of(pa.array([text, "", "z"]), 50))
    assert counts.tolist() == [5, 1, 1]
    assert until.tolist() == [2, 4, 4, 4, 4, -1, -1]
    assert since.tolist() == [-1, -1, 0, 0, 4, -1, -1]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    lengths = rng.integers(1, capacity + 1, 5000) if seed % 2 else np.minimum(capacity, 1 + rng.geometric(0.1, 5000))
    np.add.at(histogram, lengths, 1)
    rows, sequences = packing.plan(histogram, capacity)
    used = np.zeros(sequences, dtype=np.int64)
    ranks = {n: [] for n in range(1, capacity + 1)}
    taken = set()
    for length, rank, count, first, each, offset in rows.tolist():
        for i in range(count):
            sequence, at = first + i // each, offset + i % each * length
            ranks[length].append(rank + i)
            used[sequence] += length
            assert at + length <= capacity
            span = {(sequence, p) for p in range(at, at + length)}
            assert not span & taken
            taken |= span
    assert all(sorted(ranks[n]) == list(range(histogram[n])) for n in ranks)
    total = int((histogram * np.arange(capacity + 1)).sum())
    assert len(taken) == total and used.max() <= capacity
    # gapless: the filled places of a sequence start at 0 and have no hole
    top = np.zeros(sequences, dtype=np.int64)
    for sequence, p in taken:
        top[sequence] = max(top[sequence], p + 1)
    assert (top == used).all()
    assert sequences <= -(-total // capacity) * 1.02 + 2


def test_wide_sketches_bound_the_difference_after_folding():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(1, 1 << 63, size=2300, dtype=np.uint64))
    a, b = base[:2040], base[100:2300]
    words, sizes = similar._wide_sketches(np.array([len(a), len(b), 5]), np.concatenate([a, b, base[:5]]))
    assert sizes.tolist() == [32, 64, 0]
    words = words.view(np.uint64)
    x, y = words[:32], words[32:]
    y = y[:32] ^ y[32:]
    differing = len(np.setxor1d(a, b))
    assert 0 < int(np.bitwise_count(x ^ y).sum()) <= differing
