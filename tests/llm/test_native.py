"""Edge rows of the operators in Spark expressions (7, 8, 9), and their queries against SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, lines, quality
from tessera.llm.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_quality_rules", "op9_chat_formatting"])
def test_native_plans_hold_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Arrow", "Pandas", "Python"))


# ------------------------------------------------------------------ 7

def brute_lines(docs, run):
    """docs: (id, text) with unique ids, in order of id."""
    seen, out = set(), {}
    for i, text in docs:
        split = (text or "").split("\n")
        worded = [k for k, x in enumerate(split) if x.strip(" \t\n\x0b\f\r")]
        keys = [split[k].strip(" \t\n\x0b\f\r") for k in worded]
        gone = set()
        for p in range(len(keys) - run + 1):
            w = tuple(keys[p:p + run])
            gone |= set(range(p, p + run)) if w in seen else set()
            seen.add(w)
        if not gone:
            out[i] = text
            continue
        starts = [0] + worded[1:] + [len(split)]
        out[i] = "\n".join(x for p in range(len(keys)) if p not in gone for x in split[starts[p]:starts[p + 1]])
    return out


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_line_dedup_equals_brute_force(spark, docs_of, run):
    rng = random.Random(run)
    rows = [(i, "\n".join(rng.choice(["a", "b", " c ", "d\t", "", "e", f"u{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 14))))
            for i in range(120)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs_of(rows), run).collect()}
    assert got == brute_lines(rows, run)


def test_line_dedup_edge_rows(spark, docs_of):
    text = "x\ny\nz"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "x\ny"), (5, text), (6, "q\n" + text + "\n\nr"), (None, text + "\nfirst"), (7, "w\nw\nw\nw"), (5, text)]
    docs = docs_of(rows)
    out = lines.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns] + ["n_lines", "n_deleted"]
    got = Counter((r.doc_id, r.text, r.n_deleted) for r in out.collect())
    assert got == Counter([(1, None, 0), (2, "", 0), (3, "\n\n", 0), (4, "x\ny", 0), (None, text + "\nfirst", 0),
                           (5, "", 3), (5, "", 3), (6, "q\nr", 3), (7, "w", 3)])
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_long_passages_on_few_lines_go(spark, docs_of):
    one, two = " ".join(f"w{i}" for i in range(50)), [" ".join(f"{c}{i}" for i in range(25)) for c in "ab"]
    rows = [(1, f"x1\n{one}\ny1"), (2, one), (3, f"{two[0]}\n\n {two[1]}\t\nz"), (4, "q\n" + "\n".join(two)),
            (5, f"{two[1]}\n{two[0]}"), (6, " ".join(one.split()[:49])), (7, " ".join(one.split()[:49])), (8, None)]
    off = {r.doc_id: r.n_deleted for r in lines.dedup_lines(docs_of(rows), words=None).collect()}
    assert not any(off.values())
    got = {r.doc_id: (r.text, r.n_deleted) for r in lines.dedup_lines(docs_of(rows)).collect()}
    assert got == {i: (t, 0) for i, t in rows} | {2: ("", 1), 4: ("q", 2)}


@pytest.mark.parametrize("run", [1, 2, 3, 4])
def test_long_passages_equal_brute_force(spark, docs_of, run):
    rng = random.Random(run)
    pool = ["a", "b c", " d e f ", "g h i j", ""]
    rows = [(i, "\n".join(rng.choice([*pool, f"u{rng.randint(0, 40)} v"]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    seen, want = set(), {}
    for i, text in rows:
        keys, gone = [x.strip() for x in text.split("\n") if x.strip()], set()
        for n in range(1, run + 1):
            for p in range(len(keys) - n + 1):
                w = tuple(keys[p:p + n])
                if n == run or sum(len(x.split()) for x in w) >= 4:
                    gone |= set(range(p, p + n)) if w in seen else set()
                    seen.add(w)
        want[i] = len(gone)
    got = {r.doc_id: r.n_deleted for r in lines.dedup_lines(docs_of(rows), run, words=4).collect()}
    assert got == want and any(want.values())


# ------------------------------------------------------------------ 8

def brute_repeat(words, k=8):
    at = Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    hit = {j for i in range(len(words) - k + 1) if at[tuple(words[i:i + k])] > 1 for j in range(i, i + k)}
    return len(hit)


def test_repeat_words_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abc" if i % 2 else "a") for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(100, ("one two three four five six seven eight nine " * 3) + "ten"), (101, "\x0b a\tb\x0cc\r\nd ")]
    got = {r.doc_id: (r.n_words, r.n_repeat_words, r.word_chars) for r in
           quality.base_columns(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        words = [w for w in t.replace("\x0b", " ").replace("\x0c", " ").split() if w]
        assert got[i] == (len(words), brute_repeat(words), sum(map(len, words)))


def test_quality_edge_rows(spark):
    body = "\n".join(" ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(10)) + " x" * 0 for k in range(6))
    rows = [(i, f"Shared banner line here\n{body} tail{chr(97 + i)}\n{'abcdefghijklmnop'[i]} end of it", "h") for i in range(14)]
    rows += [(50, None, "h"), (51, "", None), (52, "too short", None), (0,) + rows[0][1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {c: F.lit(1) for c in ("kept", "gone", "n_words", "line", "docs")})
    kept = quality.apply_quality(docs, min_docs=10, min_kept=0.05)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert got == []  # every line but the last two is in all documents of the host: nothing is left
    loose = quality.apply_quality(docs, min_docs=13)
    got = Counter((r.doc_id, r.text) for r in loose.collect())
    assert got == Counter()
    free = quality.apply_quality(docs, min_docs=20)
    assert Counter((r.doc_id, r.text) for r in free.collect()) == Counter((r[0], r[1]) for r in rows if r[0] < 50)
    assert quality.apply_quality(docs.limit(0)).count() == 0


def test_frequent_line_goes_and_document_stays(spark):
    words = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, "Common  Footer 7\n" + " ".join(f"{a}{words[i]}" for a in words) + f"\ncommon footer {i}", "h") for i in range(26)]
    got = {r.doc_id: r.text for r in quality.apply_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {i: t.split("\n")[1] for i, t, _ in rows}


# ------------------------------------------------------------------ 9

def test_chat_reads_back_what_went_in(spark):
    nasty = ["<|im_end|>", "<|im_sep|><\\|x", "<\\\\|", "a\nb", "", "<|im_start|>assistant\nhi<|im_end|>\n", "%0A%25", "\\", "<|"]
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nro%le<|"]), rng.choice(nasty) + rng.choice(nasty)) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(40, 1, None, None), (40, None, "assistant", "x"), (40, 1, None, None), (None, 5, "assistant", "nul")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("turns", F.lit(1))
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", "loss_mask", chat.read_turns(F.col("formatted")).alias("turns"),
                                            chat.loss_text(F.col("segments")).alias("loss")).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, _, r, x in own]
        assert got[c].loss == "".join(x for _, _, r, x in own if r == "assistant")
        assert sum(m.n for m in got[c].loss_mask) == len(got[c].formatted)
        parts, at = [], 0
        for m in got[c].loss_mask:
            parts += [got[c].formatted[at:at + m.n]] if m.loss else []
            at += m.n
        unescaped = [re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in parts]
        assert unescaped == [x for _, _, r, x in own if r == "assistant"]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_adjacent_turns_of_one_role_are_merged(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).first().formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
