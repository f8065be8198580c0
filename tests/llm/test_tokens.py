import collections
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewheel.llm import packing, pieces, token_counts, two_fit
from tidewheel.llm.book import PIECES, WORDS

ODD = ["a", " ", "  ", "▁", "\n", "\t", "é", "é", "日", "😀", "the", "Ing", "<s>", "</s>", "<0x0A>", "\x00", "　", "\xa0", "'s", "12", "<|endoftext|>", "ﬁ", "Σ", "İ", "\x1c", "\x85", ".", "'", "S", "|", "\x01", "Å"]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    return ["", " ", "▁"] + ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(3000)]


@pytest.fixture(scope="module")
def by_library():
    tokenizer = Tokenizer.from_file(WORDS)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_ids_equal_the_library(odd_texts, by_library):
    from tidewheel.llm.tokens import WordTokens

    for text, ids in zip(odd_texts, WordTokens(WORDS).ids(odd_texts), strict=True):
        assert ids.tolist() == by_library(text), text


def test_each_chunk_is_looked_up_once_for_a_group_of_texts(by_library, monkeypatch):
    """Copies of a chunk are found by Arrow; the table of the worker sees each distinct chunk of a group, and encodes it once."""
    from tidewheel.llm.tokens import WordTokens

    tokens, seen, encoded = WordTokens(WORDS), [], []
    places, by_parts = tokens.table._places, tokens.table.encode
    monkeypatch.setattr(tokens.table, "_places", lambda chunks, n: seen.append(n) or places(chunks, n))
    monkeypatch.setattr(tokens.table, "encode", lambda chunks: encoded.extend(chunks) or by_parts(chunks))
    texts = ["a  word\tA word.\n", "", " \x1cword a", "word " * 500, "\xa0 a\u2028word\x0b"]
    for _ in range(2):
        assert [x.tolist() for x in tokens.ids(texts)] == [by_library(t) for t in texts]
    assert max(seen) <= 9 and len(encoded) == len(set(encoded)) == seen[0]
    assert [x.tolist() for x in tokens.ids([])] == []


def test_a_finished_task_leaves_no_tables_in_its_worker(docs):
    from tidewheel.llm.tokens import word_tokens

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            tokens = word_tokens(WORDS)
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens.table.known) + len(tokens.parts.known)])], ["n"])

    for made in (packing.pack(docs, WORDS, digest=True), token_counts.token_lengths(docs, WORDS), two_fit.pack(docs, WORDS, digest=True)):
        assert made.count() > 0
        assert sum(r.n for r in docs.select("doc_id").mapInArrow(held, "n long").collect()) == 0


def test_a_word_table_that_starts_anew_or_fails_changes_nothing(odd_texts, by_library, monkeypatch):
    from tidewheel.llm.tokens import WordTokens

    tokens = WordTokens(WORDS)
    tokens.table.limit, tokens.parts.limit = 40, 30
    found = [x for a in range(0, len(odd_texts), 40) for x in tokens.ids(odd_texts[a : a + 40])]
    assert [x.tolist() for x in found] == [by_library(t) for t in odd_texts]
    with monkeypatch.context() as patch:
        patch.setattr(tokens, "_ids", lambda text: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tokens.ids(["chunks that were never seen"])
    assert tokens.ids(["chunks that were never seen"])[0].tolist() == by_library("chunks that were never seen")


def test_pieces_equal_the_library(odd_texts):
    model = pieces.PieceModel(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    flat, ends = model.encode(odd_texts)
    lists = [x.tolist() for x in np.split(flat, ends[:-1])]
    assert lists == library.encode(odd_texts)
    rng = random.Random(6)
    lists += [[rng.randrange(32000) for _ in range(rng.randint(0, 9))] for _ in range(2000)]
    found = model.decode(np.array(sum(lists, [])), np.cumsum([len(x) for x in lists]))
    assert found == library.decode(lists)


def test_a_chunk_table_that_starts_anew_changes_nothing(odd_texts):
    model = pieces.PieceModel(PIECES)
    flat, ends = model.encode(odd_texts)
    model.encoded.limit = 50
    parts = [model.encode(odd_texts[a : a + 40]) for a in range(0, len(odd_texts), 40)]
    assert np.array_equal(np.concatenate([p for p, _ in parts]), flat)


def test_encode_and_decode_rows(docs, no_docs, messy):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.decode(pieces.encode(docs, PIECES), PIECES).select("doc_id", "decoded", pieces.ids_text().alias("t")).collect()
    want = [(d, library.decode(library.encode(t or "")), ",".join(map(str, library.encode(t or "")))) for d, t in messy]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert pieces.decode(pieces.encode(no_docs, PIECES), PIECES).count() == 0


def windows_of(rows):
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    fills = []
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        fills.append(at)
    return fills


def test_packing_places_every_id_once(docs, messy, by_library):
    rows = packing.pack(docs, WORDS, digest=True).collect()
    full = packing.pack(docs, WORDS, window=64).collect()
    want = collections.Counter((d, len(by_library(t)) + 1) for d, t in messy)
    for found, window in ((rows, 4096), (full, 64)):
        ids = collections.Counter()
        for r in found:
            ids[r.doc_id, r.doc_tokens] += r.length
        assert ids == collections.Counter({k: k[1] * n for k, n in want.items()})
        fills = windows_of(found)
        assert all(f == window or f & (f - 1) == 0 for f in fills) and max(fills) <= window
    by_id = {d: np.array(by_library(t) + [2], "<u4") for d, t in messy if d is not None and d not in (3, 4, 5)}
    for r in rows:
        if r.doc_id in by_id:
            assert r.ids_crc32 == zlib.crc32(by_id[r.doc_id][r.start : r.start + r.length].tobytes())
    for r in full:
        if r.doc_id in by_id:
            assert r.ids == by_id[r.doc_id][r.start : r.start + r.length].tolist()


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, WORDS).count() == 0


def test_level_leaves_the_least_sum_of_squares():
    rng = random.Random(1)
    for _ in range(200):
        packer = packing.SquaresPacker(window=20)
        for level in range(1, 20):
            packer.levels[level] = rng.choice([0, 0, 1, 3])
        size = rng.randint(1, 19)
        sums = {}
        for level in range(0, 21 - size):
            after = packer.levels.copy()
            if level and not after[level]:
                continue
            after[level] -= 1 if level else 0
            after[level + size] += 1
            sums[level] = int((after[1:20] ** 2).sum())
        best = packer.level_for(size)
        assert sums[best] == min(sums.values()) and best == max(k for k, v in sums.items() if v == min(sums.values()))


def test_settling_keeps_ids_in_order_of_their_places():
    packer = packing.SquaresPacker(window=32, max_open=4)
    rng = random.Random(2)
    texts = {i: np.arange(rng.randint(1, 90), dtype=np.uint32) for i in range(300)}
    for i, ids in texts.items():
        packer.add(i, ids)
        assert packer.n_open <= 5
    got = collections.defaultdict(list)
    for window in packer.closed + packer.finish():
        for doc, start, ids, total in window:
            assert ids.tolist() == list(range(start, start + len(ids))) and total == len(texts[doc])
            got[doc] += ids.tolist()
    assert all(sorted(got[i]) == ids.tolist() for i, ids in texts.items())


def test_length_histogram_answers_every_limit(docs, no_docs, messy, by_library):
    lengths = token_counts.token_lengths(docs, WORDS)
    found = token_counts.length_histogram(lengths)
    sizes = sorted(len(by_library(t)) for _, t in messy)
    rows = {r.length: r for r in found.collect()}
    assert set(rows) == set(sizes)
    for at, r in rows.items():
        assert (r.n_docs, r.docs_upto, r.docs_longer) == (sizes.count(at), sum(s <= at for s in sizes), sum(s > at for s in sizes))
        assert (r.tokens_upto, r.tokens_longer, r.truncated_tokens) == (sum(s for s in sizes if s <= at), sum(s for s in sizes if s > at), sum(min(s, at) for s in sizes))
    for r in token_counts.at_limits(found, [0, 1, 17, 512, 10**6]).collect():
        assert (r.docs_fit, r.docs_cut, r.truncated_tokens) == (sum(s <= r.context for s in sizes), sum(s > r.context for s in sizes), sum(min(s, r.context) for s in sizes))
    for r in token_counts.quantiles(found, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r.length == min(s for s in sizes if sum(x <= s for x in sizes) >= r.share * len(sizes))
    assert token_counts.length_histogram(token_counts.token_lengths(no_docs, WORDS)).count() == 0

