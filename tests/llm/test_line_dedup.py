"""Line dedup against a loop over all runs."""

from __future__ import annotations

import random

from stayspark.llm import line_dedup

SCHEMA = "doc_id bigint, text string, line string, seq int, n_chars bigint"


def by_hand(texts: list[str | None], min_chars: int) -> list[str | None]:
    """Marks every run of enough characters that starts somewhere earlier too."""
    symbols = []
    for d, text in enumerate(texts):
        lines = (text or "").split("\n")
        symbols.append([(i, x) for i, x in enumerate(lines) if x.strip(" ")])
    seen, gone = set(), [set() for _ in texts]
    for d, row in enumerate(symbols):
        for i in range(len(row)):
            for j in range(i + 1, len(row) + 1):
                run = tuple(x for _, x in row[i:j])
                if sum(len(x.strip(" ")) for x in run) >= min_chars and run in seen:
                    gone[d].update(k for k, _ in row[i:j])
            for j in range(i + 1, len(row) + 1):
                seen.add(tuple(x for _, x in row[i:j]))
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in enumerate(texts)]


def test_against_all_runs(spark):
    rng = random.Random(4)
    for pool, min_chars in ((6, 7), (30, 10), (3, 24)):
        lines = [rng.choice("abcdé") * rng.randint(1, 5) for _ in range(pool)] + ["", "  ", "a line that is long enough"]
        texts: list[str | None] = [None, "", "\n\n"]
        for _ in range(60):
            texts.append("\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14))))
        texts += [texts[5], texts[9] + "\n" + texts[12]]
        docs = spark.createDataFrame([(i, t, "clash", 1, None) for i, t in enumerate(texts)], SCHEMA)
        got = {r.doc_id: r for r in line_dedup.deduplicate(docs, min_chars).collect()}
        expected = by_hand(texts, min_chars)
        assert [got[i].text for i in range(len(texts))] == expected
        assert all(r.line == "clash" for r in got.values())


def test_repeated_rows_null_ids_and_empty_table(spark):
    passage = "a passage that is repeated in some documents"
    rows = [(1, passage, "", 0, 5), (1, passage, "", 0, 5), (2, "x\n" + passage, "", 0, 5), (None, passage, "", 0, 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.deduplicate(docs).collect())
    assert got == [("1", passage), ("1", passage), ("2", "x"), ("None", "")]
    kept = sorted((str(r.doc_id), r.n_chars) for r in line_dedup.remove_copies(docs).collect())
    assert kept == [("1", 5), ("1", 5), ("2", 1)]
    assert line_dedup.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_line_in_most_documents_and_a_long_document(spark):
    common = "this line stands in nearly every document"
    rows = [(i, f"{common}\nline number {i} is its own and stays", "", 0, 0) for i in range(3000)]
    rows.append((5000, "\n".join(f"l{i % 700}" for i in range(4000)), "", 0, 0))
    got = {r.doc_id: r for r in line_dedup.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0].dedup_removed == 0 and all(got[i].dedup_removed == 1 for i in range(1, 3000))
    assert got[5000].dedup_removed == 3300
