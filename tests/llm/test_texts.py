"""Hashes of byte spans, token ids, checksums."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import AddedToken, Tokenizer

from clickloom.llm import batches, checksums, tokens

PIECES = [" ", "\n", "\t", "\r", "\x1c", "\x85", " ", "　", " ", "a", "B9", "'s", "!", "é", "中", "😀", " the", "don't", "<|endoftext|>"]


def texts(count: int, longest: int, seed: int = 1) -> list[str]:
    source = random.Random(seed)
    return ["".join(source.choice(PIECES) for _ in range(source.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_plain_encoding(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 2000)
    monkeypatch.setattr(tokens, "MOST_KNOWN", 500)
    values = ["", " ", "\n", "a ", " a", "a\n", "\na", "x" * 5000, *texts(2000, 40)]
    data, offsets = batches.text_bytes(pa.array(values))
    ids, starts = encoder.encode(data, offsets)
    for n, one in enumerate(encoder.tokenizer.encode_batch(values, add_special_tokens=False)):
        assert ids[starts[n] : starts[n + 1]].tolist() == one.ids, values[n]


def test_special_tokens_are_encoded_as_by_a_fresh_tokenizer(encoder):
    fresh = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    values = [f"a {end} b", f"a   {end}   b", f"a\n{end}\nb", f"a\n {end}\n c", end, end * 2, f" {end}", f"{end} ", "<|endof", "text|> a", *texts(2000, 40, 2)]
    ids, starts = encoder.encode(*batches.text_bytes(pa.array(values)))
    for n, one in enumerate(fresh.encode_batch(values, add_special_tokens=False)):
        assert ids[starts[n] : starts[n + 1]].tolist() == one.ids, values[n]
    assert ids[: starts[1]].tolist() == [64, 220, 50256, 275]


def test_added_tokens_that_take_white_space_or_hold_it(tmp_path):
    fresh = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fresh.add_tokens([AddedToken("<|l|>", lstrip=True, normalized=False), AddedToken("<|r|>", rstrip=True, normalized=False)])
    fresh.add_tokens([AddedToken("<|a b|>", normalized=False), AddedToken("<|w", single_word=True, normalized=False), "    "])
    fresh.save(str(tmp_path / "added.json"))
    source = random.Random(5)
    pieces = [*PIECES, "<|l|>", "<|r|>", "<|a b|>", "<|a", " b|>", "<|w", "    ", "  "]
    values = ["".join(source.choice(pieces) for _ in range(source.randint(0, 30))) for _ in range(3000)]
    ids, starts = tokens.Encoder(str(tmp_path / "added.json")).encode(*batches.text_bytes(pa.array(values)))
    for n, one in enumerate(fresh.encode_batch(values, add_special_tokens=False)):
        assert ids[starts[n] : starts[n + 1]].tolist() == one.ids, values[n]


def test_null_and_sliced_columns_are_read_as_texts():
    column = pa.array(["ab", None, "", "cde"]).slice(1)
    data, offsets = batches.text_bytes(column)
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 0, 3]
    data, offsets = batches.text_bytes(pa.array([], pa.string()))
    assert len(data) == 0 and offsets.tolist() == [0]


def test_slices_cover_all_and_only_a_long_value_exceeds_them():
    values = ["a" * n for n in (3, 0, 50, 1, 1, 0, 9)]
    data, offsets = batches.text_bytes(pa.array(values))
    found = []
    for first, last, part, places in batches.slices(data, offsets, 10):
        assert len(part) <= 10 or last == first + 1
        found += [part[a:b].tobytes().decode() for a, b in zip(places[:-1], places[1:], strict=True)]
    assert found == values


def test_spans_and_their_hashes():
    values = ["one two  two", "", " ", "two", "x" * 300_000 + " one"]
    data, offsets = batches.text_bytes(pa.array(values))
    starts, ends, firsts = batches.spans(batches.NOT_SPACE[data], offsets)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert words == [word for value in values for word in value.split()]
    assert np.diff(firsts).tolist() == [3, 0, 0, 1, 2]
    for lane in (0, 1):
        hashes = batches.span_hashes(data, starts, ends, lane)
        same = {word: set(hashes[[w == word for w in words]].tolist()) for word in words}
        assert all(len(found) == 1 for found in same.values())
        assert len(set.union(*same.values())) == len(same)


def test_checksums():
    values = [b"123456789", b"", b"a", bytes(1000), bytes(range(256)) * 5]
    found = checksums.crc32c(values)
    assert found[0] == 0xE3069283 and found[1] == 0

    def plain(value: bytes) -> int:
        state = 0xFFFFFFFF
        for byte in value:
            state ^= byte
            for _ in range(8):
                state = state >> 1 ^ (0x82F63B78 if state & 1 else 0)
        return state ^ 0xFFFFFFFF

    assert found.tolist() == [plain(value) for value in values]
    assert len(checksums.crc32c([])) == 0
