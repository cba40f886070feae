import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableshift.llm.bpe import Codec, Transducer, Utf8Stream, decode_stream, encode_documents, read_ranks
from tableshift.llm.packing import Mixture, WordTokenizer, pack, sequences

RANKS_PATH, WORDS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
RANKS = read_ranks(RANKS_PATH)
CODEC = Codec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "  a  b\n c \n\n d", "it's they'll 'tis  's", "a" * 9000, "ab" * 6000, "日本語 テキスト " * 20, "<|endoftext|> x", "\x1c \x85 　x",
       "== -- ==" * 80, "\t\tx  y\r\n", "x́ ́y"]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(text):
    ids = CODEC.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'aeinrst.,1é日"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_equals_the_library(text):
    ids = CODEC.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert "".join(decode_stream(CODEC.table, np.frombuffer(ids, "<u4").tolist(), 3)) == text


def test_small_tables_are_forgotten_without_harm():
    small, rng = Transducer(RANKS, most_states=50, most_pairs=20), random.Random(3)
    for _ in range(60):
        piece = bytes(rng.choice(b"abenrst") for _ in range(rng.randrange(1, 40)))
        out = []
        small.encode(piece, out)
        assert out == small.merged(piece) or piece in RANKS
    out = []
    long = b"banana" * 3000
    small.encode(long, out)
    assert out == LIBRARY.encode_ordinary(long.decode())


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(1, 5), max_size=40))
def test_utf8_stream_does_not_depend_on_the_cuts(data, cuts):
    state, at, out = Utf8Stream(), 0, []
    for n in [*cuts, len(data)]:
        out.append(state.feed(data[at:at + n]))
        at += n
    assert "".join(out) + state.close() == data.decode("utf-8", "replace")


def test_encode_documents(docs_of, odd_rows):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in encode_documents(docs_of(odd_rows), RANKS_PATH, public_tokenizers.PATTERN).collect()}
    want = set()
    for i, t, *_ in odd_rows:
        ids = np.array(LIBRARY.encode_ordinary(t or ""), "<u4")
        want.add((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    assert encode_documents(docs_of([]), RANKS_PATH, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x0b\x1c'aeinrstL.,1éΣ日́"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_words_are_tokenized_like_whole_texts(text):
    own = WORDS_TOKENIZER
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


WORDS_TOKENIZER = WordTokenizer(WORDS_PATH, most=50)
#: A last letter that NFC or lower-casing turns into letter and mark, and capitals whose mark only the small letter joins.
TURNED = ["\u09b9\u09df,", "\u09ac\u09a1\u09bc,", "\u09a1\u09dc.", "\u09dd!", "\u092a\u0939\u093e\u095c,", "BELED\u0130YES\u0130:", "\u0130,", "\ufb2a.",
          "H\u0331", "T\u0308,", "W\u030a", "Y\u030a.", "J\u030c", "aH\u0331b,", "J\u030cE", "\u03a3\u0391\u03a3,", "\u00c9t\u00e9."]


@pytest.mark.parametrize("word", TURNED)
def test_words_turned_by_the_normaliser_equal_the_library(word):
    texts, library = [word, f"x {word} X", word.lower()], WORDS_TOKENIZER.library
    for ids, t in zip(WordTokenizer(WORDS_PATH).encode(texts), texts):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_every_letter_before_a_mark_equals_the_library():
    letters = [chr(c) for c in range(128, 0x110000) if chr(c).isalpha() and not 0x3400 <= c < 0xd800 and c < 0x20000]
    texts = [f"a{x}," for x in letters] + [f"A{x}" for x in letters]
    library = WORDS_TOKENIZER.library.encode_batch(texts, add_special_tokens=False)
    own = WordTokenizer(WORDS_PATH).encode(texts)
    assert [t for t, a, b in zip(texts, own, library) if np.frombuffer(a, "<u4").tolist() != b.ids] == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(64, 10**13 // 2), min_size=1, max_size=6), st.data())
def test_windows_are_full_and_shares_exact(counts, data):
    size = 64
    total = sum(counts)
    counts = [c for c in counts if c * size >= total] or counts[:1]
    mixture = Mixture(counts, size)
    total = sum(counts)
    w = data.draw(st.integers(0, mixture.windows - 1))
    before = [sum(int(mixture.taken(np.array([v]), j)[0]) for j in range(len(counts))) for v in (w, w + 1)]
    assert before == [min(w * size, total), min((w + 1) * size, total)]
    for j, c in enumerate(counts):
        taken = int(mixture.taken(np.array([w]), j)[0])
        assert abs(taken - c * w * size / total) <= 1 + c * w * size / total * 1e-12
        assert int(mixture.before(np.array([w]), j)[0]) == w * size * sum(counts[:j]) // total
        token = data.draw(st.integers(0, c - 1))
        home = mixture.window_of(np.array([token]), j)
        assert mixture.taken(home, j)[0] <= token < mixture.taken(home + 1, j)[0]


def check_pack(docs, rows, size):
    library = Tokenizer.from_file(WORDS_PATH)
    library.encode_special_tokens = True
    pieces = pack(docs, WORDS_PATH, size=size, with_ids=True)
    got = pieces.collect()
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(library.encode(r[1] or "", add_special_tokens=False).ids + [2])
    have, placed = defaultdict(list), defaultdict(list)
    for p in got:
        assert p.ids_crc32 == zlib.crc32(p.ids) and p.length == len(p.ids) // 4 > 0
        have[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
        placed[p.sequence_id].append((p.offset, p.length))
    for i, texts in want.items():
        if len(texts) == 1:
            assert sum((ids for _, ids in sorted(have[i])), []) == texts[0]
        else:
            assert sorted(sum((ids for _, ids in have[i]), [])) == sorted(sum(texts, []))
    total = sum(len(t) for x in want.values() for t in x)
    assert sorted(placed) == list(range(-(-total // size)))
    for s, parts in placed.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or s == max(placed)
    return pieces, got


def test_pack_keeps_the_mixture(docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "xylophone", "überall"]) for _ in range(rng.randrange(1, 200))), "en",
             "big" if i % 3 == 0 else f"s{i % 4}" if i % 50 else None) for i in range(400)]
    pieces, got = check_pack(docs_of(rows), rows, 256)
    source = {r[0]: r[3] for r in rows}
    counts = defaultdict(lambda: defaultdict(int))
    for p in got:
        counts[source[p.doc_id]][p.sequence_id] += p.length
    last = max(p.sequence_id for p in got)
    for own in counts.values():
        if sum(own.values()) > 3 * last:
            each = [own[s] for s in range(last)]
            assert max(each) - min(each) <= 2
    whole = sequences(pieces, 256).collect()
    assert len(whole) == last + 1 and all(len(r.ids) == 4 * 256 for r in whole)


def test_pack_odd_and_no_rows(docs_of, odd_rows):
    check_pack(docs_of(odd_rows), odd_rows, 4096)
    assert pack(docs_of([]), WORDS_PATH).collect() == []


def test_many_tiny_sources_share_a_queue(docs_of):
    rows = [(i, "word " * 30, "en", "main") for i in range(300)] + [(1000 + i, None, "en", f"tiny{i}") for i in range(40)]
    check_pack(docs_of(rows), rows, 64)


def tokens_by_window(rows, got):
    source, counts = {r[0]: r[3] for r in rows}, defaultdict(lambda: defaultdict(int))
    for p in got:
        counts[source[p.doc_id]][p.sequence_id] += p.length
    return counts, max(p.sequence_id for p in got)


def test_300_equal_sources_each_have_a_queue(docs_of):
    rows = [(i, "word " * 39, "en", f"s{i // 8}") for i in range(2400)]
    counts, last = tokens_by_window(rows, check_pack(docs_of(rows), rows, 1024)[1])
    assert len(counts) == 300
    for own in counts.values():
        assert {own[w] for w in range(last)} <= {2, 3, 4, 5}


def test_small_sources_are_served_by_exact_shares(docs_of):
    # 200 sources that are owed 0.16 tokens in a window of 64 have half of all tokens, another has the other half.
    rows = [(i, "word " * 9, "en", f"s{i // 10}") for i in range(2000)] + [(5000 + i, "word " * 9, "en", "big") for i in range(2000)]
    counts, last = tokens_by_window(rows, check_pack(docs_of(rows), rows, 64)[1])
    assert {counts["big"][w] for w in range(last)} <= {31, 32, 33}
    for name in set(counts) - {"big"}:
        own = np.cumsum([counts[name][w] for w in range(last + 1)])
        assert np.abs(own - 100 * np.arange(1, last + 2) / (last + 1)).max() <= 12  # a document and a window's tokens


def test_a_rest_below_a_token_a_window_is_spread(docs_of):
    rows = [(i, "word " * 59, "en", "main") for i in range(300)] + [(1000 + i, None, "en", f"tiny{i}") for i in range(100)]
    _, got = check_pack(docs_of(rows), rows, 64)
    last = max(p.sequence_id for p in got)
    at = np.sort([p.sequence_id for p in got if p.doc_id >= 1000])
    assert len(at) == 100 and np.abs(at - np.arange(100) * last / 100).max() < 4


def test_sources_that_are_all_small_are_mixed(docs_of):
    rows = [(i, "word " * 9, "en", f"s{i // 4}") for i in range(400)]
    counts, last = tokens_by_window(rows, check_pack(docs_of(rows), rows, 64)[1])
    for own in counts.values():
        served = np.cumsum([own[w] for w in range(last + 1)])
        assert np.abs(served - 40 * np.arange(1, last + 2) / (last + 1)).max() <= 12
