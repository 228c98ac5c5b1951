"""Line-first cleaning against a plain Python version."""

import re
from collections import Counter

from ledgerline.llm.line_quality import BOILERPLATE, NAVIGATION, SEPARATORS, clean_lines

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, max_loss=0.5):
    text = text or ""
    words = WORD.findall(text)
    seen, dup, removed, removed_words, n_lines, kept_lines = set(), 0, 0, 0, 0, []
    for line in text.split("\n"):
        w = WORD.findall(line)
        if w:
            n_lines += 1
            dup += line in seen
            seen.add(line)
            n, trimmed = len(w), " ".join(w)
            fails = (
                (n < 4 and not re.search(r"[.!?…:;\"'”»)\]。！？]\Z", trimmed))
                or (n >= 3 and 2 * sum(x.endswith("!!") for x in w) > n)
                or 10 * len(re.findall(r"[#*$%&|<>]", line)) > sum(map(len, w))
                or ((s := sum(x in SEPARATORS for x in w)) >= 2 and 4 * s >= n)
                or (n <= 6 and re.search(NAVIGATION, trimmed.lower()))
                or (n <= 40 and re.search(BOILERPLATE, trimmed.lower()))
            )
            if fails:
                removed += 1
                removed_words += n
                continue
        kept_lines.append(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup, "n_repeat_words": len(covered), "base_failed": failed, "n_lines": n_lines, "n_removed_lines": removed,
        "n_removed_words": removed_words, "cleaned": "\n".join(kept_lines), "kept": not failed and removed_words <= max_loss * len(words),
    }


BODY = "This line holds quite a few words number {} and it ends well."
TEXTS = [
    None, "", " \t\r\x0b\x0c", "\n\n\n", "one", "a b c", "a b c a b c", "a b a b a b a b", "x x x x", "a b c d a b c e b c d",
    "\n".join(BODY.format(i) for i in range(9)),
    "\n".join([BODY.format(i) for i in range(9)] + ["Home | News | Sport | More", "Home", "Contact us today", "We use cookies here.", "Licensed under the X License.", "a###", "YES!! NO!! SO!!", "same line here now.", "same line here now.", "same line here now. "]),
    "\n".join(["Home | News | Sport"] * 30), "nbsp word　wide\x1cfs \u0085 nel", "é ü 日本 🙂🙂 🙂 x" * 40, "w" * 100_000, "the same " * 20_000,
    "\n".join(f"word{i % 977} other{i % 13} third{i % 7}" for i in range(9000)), "$ | % & < > # *", "a\r\nb\r\na\r\n",
]


def check(docs, rows):
    got = Counter(tuple(sorted(r.asDict().items(), key=str)) for r in clean_lines(docs).collect())
    want = Counter(tuple(sorted(({"doc_id": r.doc_id} | brute(r.text)).items(), key=str)) for r in rows)
    assert got == want


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[11]), (3, TEXTS[3]), (3, TEXTS[10]), (3, TEXTS[10])]
    docs = spark.createDataFrame([(d, t, "x", 1, None) for d, t in rows], "doc_id long, text string, lines string, words int, kept string")
    check(docs, docs.collect())
    assert clean_lines(docs.limit(0)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, docs.collect())


def test_labelled_rows(spark):
    """Rows labelled good stay; rows labelled bad go, as far as the labels are about form."""
    sf = "/root/testdata/sf0.01"
    docs = clean_lines(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = docs.where("toxic = 0 and not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / max(1, len(bad)) < 0.3


def test_plan_is_native(spark):
    plan = clean_lines(spark.read.parquet(f"{SF}/documents.parquet")).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("xxhash64") == 1 and "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
