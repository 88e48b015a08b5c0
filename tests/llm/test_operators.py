"""The operators against brute force, on tables with every odd case."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermet.llm import (
    chunks, common, decontamination, html_text, huffman, lattice, lsh_forest, packing, pii, queries, suffixes, tokens,
    toxicity, windows,
)

RNG = np.random.default_rng(9)
VOCABULARY = ["".join(RNG.choice(list("aeioubdgklmnprst"), int(n))) for n in RNG.integers(2, 9, 400)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(VOCABULARY, n))


PASSAGE = prose(60)
BASE = prose(120)


def changed(text: str, every: int) -> str:
    words = text.split()
    words[:: every] = [w + "x" for w in words[::every]]
    return " ".join(words)


#: NULL ids and texts, empty and blank texts, ties, repeated rows, a very long text, odd white space and letters.
DOCS = [
    (0, BASE), (1, prose(80) + " " + PASSAGE), (2, PASSAGE + " " + prose(30)), (3, None), (4, ""), (5, " \t\n "),
    (6, BASE), (7, BASE.upper()), (8, changed(BASE, 60)), (9, changed(BASE, 3)), (10, "one two"), (11, "one two"),
    (12, "ünï  cödé   日本語 <|endoftext|> it's 'tis   12\n\n3"), (13, prose(40) + "\n" + PASSAGE + "\t" + PASSAGE),
    (14, "x" * 3000), (14, "x" * 3000), (15, prose(9000)), (None, BASE), (16, "la " * 500), (17, PASSAGE[:50]),
    (18, "a\x0bb\x0cc\x1cd"), (None, None),
]
SCHEMA = "doc_id long, text string, chunk int, row string, n int"


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns carry the names that the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "r", 2) for i, t in DOCS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 4000)


def rank(i):
    return -1 if i is None else i


def library_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_pieces_of_texts_encode_as_the_library_does():
    enc = tokens.Encoder(queries.tokenizer_path())
    texts = [t or "" for _, t in DOCS] + ["", " ", "a ", " a", "a  b", "a \n b", "\n \n", "don't, x. y,. z,"]
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in enc.encode(texts)] == [library_ids(t) for t in texts]
    enc.forget()
    assert [x.tolist() for x in enc.encode(texts)] == [library_ids(t) for t in texts]


def test_library_gets_few_characters_at_once(monkeypatch):
    monkeypatch.setattr(tokens, "LIBRARY", 40)
    enc, asked = tokens.Encoder(queries.tokenizer_path()), []

    class Asked:
        def encode_batch_fast(self, texts, real=enc.tokenizer, **how):
            asked.append(sum(map(len, texts)))
            return real.encode_batch_fast(texts, **how)

    enc.tokenizer = Asked()
    texts = ["", "one  two", *(f"word{i} and, more{i}." for i in range(60)), "end "]
    assert [x.tolist() for x in enc.encode(texts)] == [library_ids(t) for t in texts]
    # First texts' heads; last the pieces, a hundred joined.
    assert sum(x <= 50 for x in asked) >= 8


def test_a_word_is_asked_once_whatever_marks_and_lines_follow(monkeypatch):
    monkeypatch.setattr(tokens, "STEP", 1000)
    enc, asked = tokens.Encoder(queries.tokenizer_path()), []

    class Asked:
        def encode_batch_fast(self, texts, real=enc.tokenizer, **how):
            asked.append(sum(map(len, texts)))
            return real.encode_batch_fast(texts, **how)

    enc.tokenizer = Asked()
    words = [f"w{chr(97 + i)}{chr(97 + k)}rdé" for i in range(10) for k in range(10)]
    ends = ["", ".", ",", "$$$", ".\nNext", ")", "; -", "'s", " \n   x"]
    texts = [f"Of {w}{e} on {w}{f}" for w in words for e, f in itertools.product(ends, ends)]
    whole = tokens.Encoder(queries.tokenizer_path()).ids(texts)
    assert [x.tolist() for x in enc.encode(texts)] == [x.tolist() for x in whole]
    # 100 words of six characters and a space, and a few ends.
    assert sum(asked) < 1000


def test_cuts_never_part_what_the_library_matches():
    white = ["\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000"]
    others = [" ", "  ", "a", "12", ".", "'", "'s", "'ll", "é", "×", "²", "Ж", "中", "—", "\u0301", "\0", "😀", "<|endoftext|>"]
    texts = ["".join(x) for n in (1, 2, 3) for x in itertools.product([*others, *white], repeat=n)]
    enc = tokens.Encoder(queries.tokenizer_path())
    assert [x.tolist() for x in enc.encode(texts)] == [x.tolist() for x in enc.ids(texts)]


def test_pieces_of_equal_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "fingerprints", lambda blob, starts, lengths: lengths.astype(np.uint64) // 4)
    monkeypatch.setattr(tokens, "STEP", 20)
    monkeypatch.setattr(tokens, "REMEMBER", 60)
    enc = tokens.Encoder(queries.tokenizer_path())
    texts = [f"{a} {b}on, {a}{b}é\n{b}'s  {a}." for a in "abcd" for b in ("the", "of", "ing", "中")]
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(texts)] == [library_ids(t) for t in texts]


def test_known_pieces_are_found_again_after_some_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 40)
    enc, asked = tokens.Encoder(queries.tokenizer_path()), []
    often = "often met words are kept " * 3
    list(enc.encode([often + " ".join(f"rare{chr(97 + i)}" for i in range(26)), often]))
    enc.forget()
    monkeypatch.setattr(enc, "ids", lambda texts: asked.append(texts))
    assert [x.tolist() for x in enc.encode([often.strip()])] == [library_ids(often.strip())] and not asked


def test_memory_of_a_step_of_encoding_is_returned(monkeypatch):
    monkeypatch.setattr(tokens, "STEP", 10)
    enc, trimmed = tokens.Encoder(queries.tokenizer_path()), []
    monkeypatch.setattr(tokens, "trim", lambda: trimmed.append(1))
    assert len(list(enc.encode(["one text of many", "and another of them"]))) == len(trimmed) == 2


def test_workers_return_memory_when_operators_change(monkeypatch):
    trimmed = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: SimpleNamespace(malloc_trim=trimmed.append))
    monkeypatch.setattr(common, "_KEPT", {"tokens": {"x": 1}})
    common.kept("tokens")
    assert trimmed == []
    assert common.kept("toxicity") == {} and trimmed == [0] and list(common._KEPT) == ["toxicity"]


def test_code_lengths_are_limited_and_optimal():
    for counts, limit in (([1, 1, 2, 3, 5, 8, 13, 21], 4), ([5], 3), ([0, 0, 7, 1], 9), ([0], 5), (list(2 ** np.arange(30)), 6)):
        lengths = huffman.code_lengths(np.array(counts), limit)
        used = [int(x) for x in lengths if x]
        assert len(used) == sum(c > 0 for c in counts) and max(used, default=0) <= limit
        assert sum(2.0**-x for x in used) <= 1
    best = min(
        sum(c * x for c, x in zip([1, 1, 2, 3, 5], ls))
        for ls in itertools.product(range(1, 4), repeat=5)
        if sum(2.0**-x for x in ls) <= 1
    )
    lengths = huffman.code_lengths(np.array([1, 1, 2, 3, 5]), 3)
    assert int((lengths * np.array([1, 1, 2, 3, 5])).sum()) == best


def test_ids_take_two_bytes_where_they_fit(spark, docs):
    for end, width in ((0, 2), (65_535, 2), (65_536, 4)):
        rows = huffman.token_ids(docs, queries.tokenizer_path(), end).where("counts IS NULL").collect()
        assert len(rows) == len(DOCS) and {len(r.ids) / r.n for r in rows} == {width}


def test_codes_of_any_length_and_number_are_read_back():
    rng = np.random.default_rng(5)
    for used, n in ((1, 1), (2, 127), (40, 1000), (300, 128), (50_000, 70_001)):
        counts = (2.0 ** rng.uniform(0, 40, used)).astype(np.int64)
        code = huffman.Code(huffman.code_lengths(counts))
        ids = rng.integers(0, used, n)
        payload, marks = huffman.pack_bits(code.entries()[ids])
        bits = "".join(f"{code.codes()[i]:0{code.lengths[i]}b}" for i in ids.tolist())
        assert payload == int(bits.ljust(-len(bits) % 8 + len(bits), "0"), 2).to_bytes(len(payload))
        assert marks.tolist() == np.cumsum([0, *code.lengths[ids].tolist()])[:-1][:: huffman.STRIDE].tolist()
        assert (huffman.unpack_bits(payload, marks, code.table()).reshape(-1)[:n] == ids).all()


def test_token_files_round_trip(spark, docs, none, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 700)
    huffman.write_ids(docs, queries.tokenizer_path(), str(tmp_path / "f"))
    got = {}
    for r in huffman.read_ids(spark, str(tmp_path / "f")).orderBy("first").collect():
        got.setdefault((r.start, r.doc_id), []).append(np.frombuffer(r.ids, "<u4"))
    starts = sorted(got)
    assert [k for _, k in starts] == sorted((i for i, _ in DOCS), key=rank)
    want = Counter((i, tuple(library_ids(t) + [0])) for i, t in DOCS)
    assert Counter((i, tuple(np.concatenate(v).tolist())) for (_, i), v in got.items()) == want
    at = 0
    for start, i in starts:
        assert start == at
        at += sum(map(len, got[start, i]))
    huffman.write_ids(none, queries.tokenizer_path(), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e/lengths")).count() == 0


def test_combined_checksum(spark):
    parts = [b"abc", b"", b"defgh" * 99]
    row = [(i, len(p), zlib.crc32(p)) for i, p in enumerate(parts)]
    df = spark.createDataFrame([(row,)], "p array<struct<first:long,size:long,crc:long>>")
    assert df.select(queries.combined_crc32("p")).first()[0] == zlib.crc32(b"".join(parts))


def test_packing_loses_nothing_and_fills(docs, none):
    rows = [r.asDict() for r in queries.packed_rows(docs).collect()]
    assert sum(r["length"] for r in rows) == sum(len(library_ids(t)) + 1 for _, t in DOCS)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert 1 <= r["length"] <= 1024 and (r["piece"] == 0 or r["length"] == 1024)
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == list(itertools.accumulate([0, *(n for _, n in places[:-1])]))
        assert sum(n for _, n in places) <= 1024
    assert queries.packed_rows(none).count() == 0


def test_local_search_empties_bins():
    sizes = RNG.integers(1, 1024, 3000).tolist()
    bins = packing.Bins(sizes, 1024)
    bins.best_fit()
    before, squares = sum(f > 0 for f in bins.fill), sum(f * f for f in bins.fill)
    bins.search()
    assert sum(f * f for f in bins.fill) >= squares and sum(f > 0 for f in bins.fill) <= before
    assert sorted(i for b in bins.items for i in b) == list(range(3000))
    assert all(sum(sizes[i] for i in b) == f <= 1024 for b, f in zip(bins.items, bins.fill))


ITEMS = [(1, PASSAGE), (2, "One two"), (3, None), (4, "..."), (None, BASE[: len(BASE) // 2]), (1, PASSAGE), (5, "zz yy " + PASSAGE)]


@pytest.mark.parametrize("block", [decontamination.ITEM_BYTES, 300])
def test_decontamination(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontamination, "ITEM_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    low = {i: i + 32 for i in range(65, 91)}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))

    found = {}
    for name, text in ITEMS:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            found.setdefault(tuple(w[k : k + 10]), set()).add(name)
    want = Counter()
    for i, text in DOCS:
        w = words(text)
        hit, names = set(), set()
        for k in range(len(w)):
            for n in range(1, 11):
                if tuple(w[k : k + n]) in found and k + n <= len(w):
                    hit.update(range(k, k + n))
                    names |= found[tuple(w[k : k + n])]
        want[i, len(w), len(hit), tuple(sorted(str(x) for x in names if x is not None))] += 1
    got = decontamination.mark(docs, items).select("row.doc_id", "n_words", "n_hit", "items").collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert kept.where(F.col("text").contains(PASSAGE[:200])).count() == 0
    assert kept.where("doc_id = 15").first().text == dict(DOCS)[15]
    assert decontamination.mark(none, items).count() == 0
    empty = items.where("false")
    assert decontamination.mark(docs, empty).where("n_hit > 0").count() == 0


def test_windows(docs, none):
    seen, want = {}, Counter()
    rows = sorted(DOCS, key=lambda d: (rank(d[0]), (d[1] or "").encode()))
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            seen[key] = min(seen.get(key, rank(i)), rank(i))
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone, own = set(), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if seen[key] < rank(i) or key in own:
                gone.update(range(k, k + 20))
            own.add(key)
        want[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    got = windows.dedup_substrings(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.text).decode()) for r in got) == want
    assert windows.dedup_substrings(none).count() == 0


def test_bytes(docs, none):
    first, want = {}, Counter()
    raw = [(i, (t or "").encode()) for i, t in DOCS]
    for i, b in raw:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], rank(i)), rank(i))
    for i, b in raw:
        gone = np.zeros(len(b) + 50, bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < rank(i):
                gone[k : k + 50] = True
        gone = gone[: len(b)]
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()] += 1
    got = suffixes.dedup_bytes(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text)) for r in got) == want
    assert suffixes.dedup_bytes(none).count() == 0


def test_deep_shallow_sorts():
    rows = RNG.integers(0, 2, (500, 50)).astype(np.uint8)
    rows[:300, :30] = 1
    rows[100:130] = rows[50]
    ranks, common = suffixes.deep_shallow(rows)
    distinct = sorted({r.tobytes() for r in rows})
    assert [distinct.index(r.tobytes()) for r in rows] == ranks.tolist()
    for k in range(1, len(distinct)):
        a, b = distinct[k - 1], distinct[k]
        assert common[k] == next(i for i in range(50) if a[i] != b[i])


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def smallest(nodes, linked, names):
    root = list(range(nodes))
    for _ in range(nodes):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    groups = {}
    for k in range(nodes):
        groups.setdefault(root[k], []).append(names[k])
    return [min((x for x in groups[root[k]] if x is not None), default=None) for k in range(nodes)]


def test_near_copies(docs, none):
    near = [(100 + k, changed(prose(0) + BASE, 37 + k)) for k in range(30)]
    rows = DOCS + near
    both = docs.sparkSession.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA)
    sets = [shingles(t) for _, t in rows]
    linked = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    want = smallest(len(rows), linked, [i for i, _ in rows])
    got = lsh_forest.groups(both).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (i, len(s), c) for (i, _), s, c in zip(rows, sets, want)
    )
    kept = lsh_forest.drop_near_copies(both)
    assert kept.columns == both.columns
    worded = {c for s, c in zip(sets, want) if s}
    assert kept.count() == len(worded) + sum(not s for s in sets)
    assert lsh_forest.groups(none).count() == lsh_forest.drop_near_copies(none).count() == 0


def test_personal_data(docs, spark, none):
    card = "4111111111111111"
    text = f"Mail Jane.Doe@mail.example.com, ip 10.0.0.255 not 10.0.0.256, card {card}, call +49 (151) 234-5678 é."
    again = "Jane.Doe@mail.example.com wrote; later (JANE.DOE@MAIL) signed."
    rows = [(1, text), (2, again), (3, None), (4, ""), (None, text), (5, "x@ @y 1.2.3 +1 " + "7" * 9000)]
    df = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in pii.find(df).select("row.doc_id", "counts", "base", "base_sha256", "spans").collect()}
    assert got[1].counts == got[None].counts == [1, 1, 1, 1]
    assert got[1].base_sha256 == hashlib.sha256(got[1].base.encode()).hexdigest()
    said = [text[int(a) : int(b)] for _, a, b in (x.split(":") for x in got[1].base.split(","))]
    assert said == ["Jane.Doe@mail.example.com", "10.0.0.255", card, "+49 (151) 234-5678"]
    assert got[3].spans == got[4].spans == got[5].base == ""
    assert all(set(r.base.split(",")) <= set(r.spans.split(",")) for r in got.values())
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[1].startswith("Mail <EMAIL>, ip <IP> not 10.0.0.256, card <CARD>, call <PHONE> é.")
    assert masked[3] is None and pii.find(none).count() == 0


def test_belief_propagation_is_exact_on_a_chain():
    own, steps = RNG.normal(size=(4, 5)), RNG.normal(size=(5, 5))
    got = pii.propagate(own, steps, [])
    weight = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        w = np.exp(sum(own[i, x] for i, x in enumerate(labels)) + sum(steps[a, b] for a, b in zip(labels, labels[1:])))
        for i, x in enumerate(labels):
            weight[i, x] += w
    assert np.allclose(got, weight / weight.sum(1, keepdims=True), atol=1e-2)


def test_repeats_carry_a_kind():
    field = pii.Field(np.tile([-1.0, -3, -3, -3, 0], (pii.SHAPES, 1)), np.zeros((5, 5)))
    text = "Write to jane.doe@mail.example.com . Then jane.doe@mail answered, not bob@ at all."
    base = pii.base_spans(text)
    more = field.spans(text, base)
    assert [text[a:b] for _, a, b in more] == ["jane.doe@mail"]


def test_minimum_cut_against_all_labellings():
    for _ in range(20):
        odds = RNG.integers(-9, 10, 6).tolist()
        edges = [(a, b, int(RNG.integers(0, 6))) for a, b in itertools.combinations(range(6), 2)]

        def cost(labels):
            own = sum(z if z > 0 and not y else -z if z < 0 and y else 0 for z, y in zip(odds, labels))
            return own + sum(c for a, b, c in edges if labels[a] != labels[b])

        assert cost(html_text.minimum_cut(odds, edges)) == min(map(cost, itertools.product([False, True], repeat=6)))


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><header>Site name</header><nav><a href=x>Home"
        "</a></nav><div class='cookie-notice'><p>We use cookies to make this site better for you.</p></div><article><h1>A &amp; "
        "B</h1><p><b>First paragraph\n of text,<br>quite long, it is.<p>Second one, also long enough &lt;here&gt;.</p></article>"
        "<form><p>Write to us today.</p><input></form><aside><p>Popular posts of this week.</p></aside><section id=comments>"
        "<article class=comment><p>Great read, thanks a lot for it.</p></article></section><!-- <p>no</p> --><footer>&copy; us</footer>"
    )
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<nav>menu</nav>"), (5, "u", "<<<a '"), (6, "u", "plain words")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "A & B\nFirst paragraph of text, quite long, it is.\nSecond one, also long enough <here>."
    assert got[1] == (want, len(want))
    assert got[2] == got[3] == got[4] == ("", 0)
    assert got[6] == ("plain words", 11)


ARTICLE = "<h1>Long walk</h1><p>We went up the hill in the morning, before the sun was high.</p><p>Nobody else was there.</p>"
AROUND = "<nav><a href=a>Home</a> <a href=b>News</a></nav>{}<div class=sidebar><p>Read this other story, it is very good.</p></div><footer>Imprint</footer>"
WRAPPED = [
    "<div class='layout has-sidebar'>{}</div>",
    "<article class='post related-on'>{}</article>",
    "<main class='main alert-free'>{}</main>",
    "<article class='promo'>{}</article>",
    "<div class='page' data-id='sidebar' data-class=ads title='class=menu'><article>{}</article></div>",
    "<article>{}</article>",
    "<div class=content>{}</div>",
]


@pytest.mark.parametrize("wrap", WRAPPED)
def test_names_of_the_whole_page_decide_nothing(wrap):
    want = "Long walk\nWe went up the hill in the morning, before the sun was high.\nNobody else was there."
    page = "<html><body>" + AROUND.format(wrap.format(ARTICLE)) + "</body></html>"
    assert "\n".join(html_text.main_blocks(page)[0]) == want
    # A form, or an element with a name of something else, around all that a page holds.
    if "article" in wrap or "<main" in wrap or "content" in wrap:
        form = "<html><body><form id='aspnetForm'>" + AROUND.format(wrap.format(ARTICLE)) + "</form></body></html>"
        assert "\n".join(html_text.main_blocks(form)[0]) == want


def test_other_articles_stay_away():
    teaser = "<div class=related><article><p>Another long story about a hill, with many words in it, more than here.</p></article></div>"
    reader = "<section id=comments><article><p>I have been there too, it was a very fine day, and nobody was there.</p></article></section>"
    promo = "<article class=promo><p>Buy boots now, they are good boots for every kind of hill.</p></article>"
    form = "<form class=contact><div class=form-content><p>Write to us, we will answer as soon as we can do so.</p></div></form>"
    want = "Long walk\nWe went up the hill in the morning, before the sun was high.\nNobody else was there."
    for wrap in ("<article>{}</article>", "<div class=content>{}</div>", "<main>{}</main>"):
        page = "<body>" + AROUND.format(wrap.format(ARTICLE) + teaser + reader + promo + form) + "</body>"
        assert "\n".join(html_text.main_blocks(page)[0]) == want


def test_what_is_not_shown_in_a_line_is_no_text():
    page = (
        "<article><p>We went <span hidden>unseen <b>words <i>here</b> </span>up the <b style='color:red'>hill</b> in the "
        "<i style='display: none'>night</i>morning, <em>before</em> the sun was high.</p><p>Nobody <span hidden>was</p>"
        "<p>else was there.</p></article>"
    )
    assert html_text.main_blocks(page)[0] == [
        "We went up the hill in the morning, before the sun was high.", "Nobody", "else was there.",
    ]


def test_main_text_of_odd_tables(spark):
    page = "<body><article><p>We went up the hill in the morning.</p></article></body>"
    kind = "page_id long, url string, html string, row int, text string, main_text string, n_blocks string"
    rows = [(1, "u", page, 5, "x", "y", "z"), (1, "u", page, 5, "x", "y", "z"), (None, None, page, None, None, None, None)]
    got = html_text.main_text(spark.createDataFrame(rows, kind)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [
        (i, "We went up the hill in the morning.", 35) for i in (0, 1, 1)
    ]
    assert html_text.main_text(spark.createDataFrame([], kind)).count() == 0
    long = "<article>" + "<p>We went up the hill in the morning.</p>" * 20000 + "</article>"
    assert len(html_text.main_blocks(long)[0]) == 20000


def test_lattice_points_are_nearest():
    x = RNG.normal(size=(50, 8)) * 2
    around = np.array(list(itertools.product((-1, 0, 1), repeat=8)))
    for half in (0, 1):
        got = lattice.decode_e8(x)[:, half] / 2
        near = np.rint(x - half / 2)
        best = []
        for own, whole in zip(x, near):
            points = (whole + around)[(whole + around).sum(1) % 2 == 0]
            best.append(((own - points - half / 2) ** 2).sum(1).min())
        assert np.allclose(((x - got) ** 2).sum(1), best)


def test_near_vectors(spark):
    base = RNG.normal(size=(40, 16))
    rows = [(int(i), v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[0] + RNG.normal(size=16) * 0.08 * i).tolist()) for i in range(8)]
    rows += [(200, base[1].tolist()), (200, base[1].tolist()), (201, (base[1] * 7).tolist()), (202, (-base[1]).tolist())]
    rows += [(300, None), (301, [0.0] * 16), (302, [None] * 16), (303, [float("nan")] * 16), (304, []), (305, [1.0, 2.0]),
             (306, [float("inf")] + [1.0] * 15), (None, base[2].tolist()), (307, [1e200] * 16), (308, [1e-200] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = [np.array(v) / np.abs(v).max() if v and None not in v and np.isfinite(v).all() and any(v) else None for _, v in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    linked = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95
    ]
    counts = Counter(x for pair in linked for x in pair)
    want = Counter((i, counts[k], c) for k, ((i, _), c) in enumerate(zip(rows, smallest(len(rows), linked, [i for i, _ in rows]))))
    got = lattice.near_vectors(df).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert lattice.near_vectors(df.where("false")).count() == 0


def test_lattice_recall():
    x = RNG.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = RNG.normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    a, b = lattice.cells(x, lattice.TABLES, 1.0), lattice.cells(y, lattice.TABLES, 1.0)
    met = (a.reshape(2000, -1, 2, 1) == b.reshape(2000, -1, 1, 2)).any((1, 2, 3))
    assert met.mean() >= 0.99


def test_toxicity(spark, none):
    bad = ["zorgblat", "krumpfist", "vexmoggle"]
    rows, labels = [], []
    for i in range(400):
        words = prose(60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[int(RNG.integers(0, 60))] = str(RNG.choice(bad))
        rows.append((i, " ".join(words), 1, "r", 2))
        labels.append((i, int(toxic)))
    rows += [(400, None, 1, "r", 2), (401, "", 1, "r", 2), (None, "zorgblat", 1, "r", 2)]
    labels += [(401, None), (None, 1), (999, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    label = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, label)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).select("row.doc_id", "score").collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 403
    held = [(got[i], t) for i, t in labels[:400] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == bool(t) for s, t in held]) > 0.9
    kept = toxicity.drop_toxic(df, label)
    assert kept.columns == df.columns and kept.where("doc_id IN (400, 401)").count() == 2
    assert toxicity.score(none, model).count() == 0
    one_class = toxicity.fit(df, label.where("toxic = 0"))
    assert one_class.score(one_class.gains(b"text")) == 0.0


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
