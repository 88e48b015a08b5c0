"""The pipeline as a whole, each stage against a plain version of it over that stage's own input."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quartermet.llm import pii, queries, toxicity
from tests.conftest import SF_SMALL

LOW = {i: i + 32 for i in range(65, 91)}
STAGE = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Documents as they enter each stage, the rows that leave the last, and the folder of the tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(9000))
    odd = [(None, None), (None, "a text of no id that nobody else has written down here"), (3, "another one of an id that is there"),
           (None, long), (900_001, ""), (900_002, " \t\n"), (900_003, "alone"), (900_003, "alone"), (900_004, "é ü 😀 " * 9)]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    entering = [spark.read.parquet(f"{folder}/documents.parquet")]
    kept = corpus_pipeline.stored

    def remembered(df, name):
        entering.append(kept(df, name))
        return entering[-1]

    patch = pytest.MonkeyPatch()
    patch.setattr(corpus_pipeline, "stored", remembered)
    try:
        out = corpus_pipeline.run(spark, folder).collect()
    finally:
        patch.undo()
    return folder, dict(zip(STAGE, entering, strict=True)), out


def rows(df) -> Counter:
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_stay(ran):
    _, entering, _ = ran
    assert len({tuple(df.columns) for df in entering.values()}) == 1


def test_toxic_documents_go(spark, ran):
    folder, entering, _ = ran
    docs, labels = entering["toxicity"], spark.read.parquet(f"{folder}/labels.parquet")
    scored = docs.select("doc_id", "text", toxicity.scores(F.col("text"), toxicity.fit(docs, labels)).alias("s")).collect()
    assert rows(entering["near_copies"]) == Counter((r.doc_id, r.text) for r in scored if r.s < 0.5)
    assert all(0 <= r.s <= 1 for r in scored)


def test_one_of_each_group_stays(ran):
    _, entering, _ = ran
    before = list(rows(entering["near_copies"]).elements())
    sets = []
    for _, text in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            holders[s].append(i)
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        for j, n in Counter(j for s in own for j in holders[s] if j < i).items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                root[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[top(i)].append(before[i])
    left = rows(entering["benchmark"])
    assert sum(left.values()) == len(groups) < len(before)
    for members in groups.values():
        least = min((i for i, _ in members if i is not None), default=None)
        assert sum(left[m] for m in set(members) if m[0] == least) >= 1


def test_benchmark_passages_go(spark, ran):
    folder, entering, _ = ran

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))

    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(r.text)
        windows.update(tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9) if w else 0))
    sizes = {len(w) for w in windows}
    want, clean = Counter(), Counter()
    for i, text in rows(entering["benchmark"]).elements():
        w, hit = words(text), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
        if len(hit) <= 0.5 * len(w):
            want[i, tuple(x for k, x in enumerate(w) if k not in hit)] += 1
            if not hit:
                clean[i, text] += 1
    after = rows(entering["personal_data"])
    assert Counter((i, tuple(words(t))) for i, t in after.elements()) == want
    assert clean <= after and sum(clean.values()) > 0.5 * sum(after.values())


def test_personal_data_is_masked(ran):
    _, entering, _ = ran
    docs = entering["personal_data"]
    want = Counter()
    for r in pii.find(docs).select("row.doc_id", "row.text", "base", "spans").collect():
        text, spans = r.text, [s.split(":") for s in r.spans.split(",") if s]
        plain = {m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or "")}
        assert plain == {(int(a), int(b)) for k, a, b in (s.split(":") for s in r.base.split(",") if s) if k == "email"}
        assert {s for s in r.base.split(",") if s} <= {":".join(s) for s in spans}
        taken = sorted((int(a), -int(b), k) for k, a, b in spans)
        out, at = [], 0
        for a, b, kind in taken:
            if a >= at:
                out += [text[at:a], f"<{kind.upper()}>"]
                at = -b
        want[r.doc_id, text if not out else "".join([*out, text[at:]])] += 1
    assert rows(entering["packing"]) == want


def test_packed_rows(ran):
    _, entering, out = ran
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, text in rows(entering["packing"]).elements():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    least = -(-sum(r.length for r in out) // 1024)
    assert len(sequences) <= max(least + 1, 1.01 * least)
