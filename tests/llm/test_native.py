"""Quality ledger, line chunks and sharding against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillrank.llm import line_chunks, quality_ledger, sharding

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [word for word in WHITE.split(text or "") if word]


def python_ledger(text):
    words, lines = words_of(text), [line for line in (text or "").split("\n") if words_of(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in quality_ledger.SYMBOLS for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def ledger_texts():
    draw = random.Random(1)
    fixed = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x", "  a b", "a\n\na\na ", "é́ #*$"]
    made = [" ".join(draw.choice("ab\ncé#") for _ in range(draw.randint(0, 40))) for _ in range(60)]
    return fixed + made + ["word " * 30_000 + "end", " ".join(map(str, range(20_000)))]


def test_ledger_measures(spark):
    texts = ledger_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality_ledger.verdicts(quality_ledger.ledger(df)).collect()}
    for i, text in enumerate(texts[:-2]):
        for name, value in python_ledger(text).items():
            assert got[i][name] == value, (name, text)
    assert got[len(texts) - 2]["n_repeat_words"] == 30_000 and got[len(texts) - 1]["n_repeat_words"] == 0
    assert got[0]["base_failed"] and not got[0]["kept"]


def test_policies_and_ablation_come_from_the_bits(spark):
    bits = [0, 1, 2, 3, 4, 5, 6, 64, 68]
    entries = spark.createDataFrame([(i, b) for i, b in enumerate(bits * 3)], "doc_id LONG, failed LONG")
    for policy, rules in quality_ledger.POLICIES.items():
        counted = quality_ledger.mask(rules) | quality_ledger.mask(quality_ledger.BASE)
        kept = quality_ledger.verdicts(entries, policy).where("kept").count()
        assert kept == 3 * sum(b & counted == 0 for b in bits)
    for row in quality_ledger.ablation(entries).collect():
        whole, own = quality_ledger.mask(quality_ledger.POLICIES[row["policy"]]), quality_ledger.bit(row["rule"])
        assert row["failing"] == 3 * sum(b & own != 0 for b in bits)
        assert row["alone"] == 3 * sum(b & whole == own for b in bits)
        assert row["kept_without"] == 3 * sum(b & whole & ~own == 0 for b in bits)
        assert row["kept"] == 3 * sum(b & whole == 0 for b in bits)
    assert quality_ledger.ledger(spark.createDataFrame([], "doc_id LONG, text STRING")).count() == 0


def test_ledger_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id LONG, text STRING").select("doc_id", "text")
    plan = quality_ledger.ledger(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "")


def boundaries(lines, bits):
    """Places after which the rolling hash of each line and the one before cuts ``lines``."""
    marks = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    rolled = [(line_chunks.ROLL * before + mark) % 2**32 for before, mark in zip([0, *marks], marks)]
    return [k for k, r in enumerate(rolled) if (r >> 16) % 2**bits == 0 or k == len(lines) - 1]


def python_lines(rows, min_words, bits=line_chunks.BOUNDARY_BITS, levels=(1, 2)):
    """Rows of (key, text) -> new texts, from whole chunk strings."""
    docs = sorted({(key, text) for key, text in rows if text is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, gone = {}, {}
    for key, text in docs:
        lines = [(i, line, len(words_of(line))) for i, line in enumerate(text.split("\n")) if words_of(line)]
        cuts = boundaries([line for _, line, _ in lines], bits)
        for level in levels:
            opens = range(len(lines)) if level == 2 else [0, *[k + 1 for k in cuts[:-1]]]
            closes = range(len(lines)) if level == 2 else cuts
            for k in opens:
                ends = (j for j in closes if j >= k + 2 - level and sum(n for _, _, n in lines[k : j + 1]) >= min_words)
                j = next(ends, None)
                if j is None:
                    continue
                chunk = level, "\n".join(line for _, line, _ in lines[k : j + 1])
                if first.setdefault(chunk, (key, text, k)) != (key, text, k):
                    gone.setdefault((key, text), set()).update(range(lines[k][0], lines[j][0] + 1))
    out = []
    for key, text in rows:
        drop = gone.get((key, text))
        if drop:
            left = [line for i, line in enumerate(text.split("\n")) if i not in drop]
            text = "\n".join(left) if any(map(words_of, left)) else ""
        out.append((key, text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_chunks(spark, seed):
    draw = random.Random(seed)
    pool = [" ".join(f"w{draw.randint(0, 400)}" for _ in range(draw.randint(1, 9))) for _ in range(14)] + ["", " "]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(0, 12)))) for i in range(30)]
    rows += [(None, rows[3][1]), (None, None), (50, None), (51, ""), rows[4], rows[4], (52, rows[5][1])]
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], "doc_id LONG, text STRING, places STRING, doc STRING")
    got = line_chunks.remove_repeated_chunks(df, min_words=6)
    assert got.columns == ["doc_id", "text", "places", "doc", "n_lines", "n_removed"]
    found = sorted((repr((r["doc_id"], r["text"])) for r in got.collect()))
    assert found == sorted(map(repr, python_lines(rows, 6)))


def test_line_chunks_leave_single_texts_alone(spark):
    text = "\n".join(f"line {i} " + "word " * 20 for i in range(50))
    df = spark.createDataFrame([(1, text), (2, "short\nshort\nshort")], "doc_id LONG, text STRING")
    assert {r["text"] for r in line_chunks.remove_repeated_chunks(df).collect()} == {text, "short\nshort\nshort"}
    assert line_chunks.remove_repeated_chunks(df.limit(0)).count() == 0


def test_inserted_lines_shift_no_chunk(spark):
    draw = random.Random(5)
    lines = [" ".join(f"w{draw.randint(0, 9999)}" for _ in range(10)) for _ in range(40)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["new line", *lines]))], "doc_id LONG, text STRING")
    for bits in (0, 1, 2):
        found = line_chunks.chunks(df, "doc_id", "text", 20, bits).groupBy("level", "hash").count()
        assert found.where("level = 2 and count = 1").count() <= 1  # at most what the new line opens
        # what opens at the start of either text or after the two lines whose hash holds the new one
        assert found.where("level = 1 and count = 1").count() <= 5
        assert found.where("level = 1 and count = 2").count() >= 5


def test_the_rolling_hash_bounds_chunks(spark):
    draw = random.Random(8)
    lines = [" ".join(f"w{draw.randint(0, 9999)}" for _ in range(10)) for _ in range(300)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n\n".join(lines[100:]))], "doc_id LONG, text STRING")
    for bits in (1, 3, 6):
        cuts = boundaries(lines, bits)
        found = line_chunks.chunks(df, "doc_id", "text", 50, bits).where("doc = 1 and level = 1").collect()
        opens = [0, *[k + 1 for k in cuts[:-1]]]
        expected = {(k, min(j for j in cuts if j >= k + 4)) for k in opens if cuts[-1] >= k + 4}
        assert {(r["first"], r["last"]) for r in found} == expected  # however far the next boundary is


def test_hash_bounded_chunks_take_what_words_leave(spark):
    """A chunk of the first level goes on to its boundary, where the second ends with ``min_words`` words."""
    draw = random.Random(9)
    long = " ".join(f"w{draw.randint(0, 9999)}" for _ in range(60))
    short = ["short line " + str(draw.randint(0, 9999)) for _ in range(6)]
    passage = [long, *short]
    texts = ["\n".join([f"own {i} a", f"own {i} b", *passage]) for i in range(3)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = sorted((r["doc_id"], r["text"]) for r in line_chunks.remove_repeated_chunks(df).collect())
    assert got == python_lines(rows, 50)
    assert got[0] == rows[0] and all(long not in text for _, text in got[1:])
    assert got != python_lines(rows, 50, levels=(2,))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_are_searched_once_for_each_text(spark, tmp_path):
    """Filters that Spark infers or moves must not repeat the search or the cut, nor cut inside a loop over lines."""
    path = str(tmp_path / "docs")
    rows = [(i, "\n".join([f"{'word ' * 60}{i % 2}", "b c", f"end {i}"])) for i in range(4)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING").write.parquet(path)
    docs = spark.read.parquet(path)
    assert optimized(line_chunks.chunks(docs, "doc_id", "text")).count("md5(") == 1
    left = line_chunks.remove_repeated_chunks(docs).where("n_removed = 0 or text != ''").select("doc_id", "text")
    assert optimized(left).count("array_except(") == 1 and optimized(left).count("split(") == 1
    assert sorted(map(tuple, left.collect())) == sorted(python_lines(rows, line_chunks.MIN_WORDS))


def test_chunk_texts_are_cut_inside_their_row(spark, tmp_path, monkeypatch):
    """No row for each chunk holds all lines of its text, which would be quadratic in the length of a text."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, f"{'word ' * 60}\nend {i}") for i in range(3)], "doc_id LONG, text STRING").write.parquet(path)
    plans = {}

    def kept(df, name, write=line_chunks.materialise):
        plans[name] = optimized(df)
        return write(df, name)

    monkeypatch.setattr(line_chunks, "materialise", kept)
    assert line_chunks.repeated_chunks(spark.read.parquet(path), "doc_id", "text").count() == 2
    above = plans["line-texts"].split("split(")[0]
    assert "Generate" in above and "array_join(" not in above


def test_line_chunks_run_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id LONG, text STRING").select("doc_id", "text")
    plan = line_chunks.chunks(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "")


def python_shards(rows, limit):
    """(hash, bytes) rows -> depth, by splitting the directory recursively."""
    depth = {}

    def split(part, bits):
        if sum(size for _, size in part) <= limit or len({h for h, _ in part}) == 1:
            depth.update({h: bits for h, _ in part})
            return
        for side in (0, 1):
            inner = [row for row in part if (row[0] >> (sharding.BITS - bits - 1)) & 1 == side]
            if inner:
                split(inner, bits + 1)

    split(rows, 0)
    return depth


def test_shards_fit_and_split_only_where_needed(spark):
    draw = random.Random(6)
    rows = [(draw.choice([1, 2, None, i]), "z" * draw.randint(0, 300)) for i in range(300)]
    rows += [(7, "same text " * 5)] * 90 + [(8, "x" * 9000), (9, None), (9, "")]
    df = spark.createDataFrame([(*row, "x") for row in rows], "doc_id LONG, text STRING, hash STRING")
    got = sharding.assign(df, limit=1000).collect()
    assert len(got) == len(rows)
    depths = python_shards([(r["hash"], r["n_bytes"]) for r in got], 1000)
    shards = {}
    for r in got:
        assert r["depth"] == depths[r["hash"]] == len(r["bits"])
        shards.setdefault((r["bits"], r["part"]), []).append(r["n_bytes"])
    assert all(sum(sizes) <= 1000 or len([s for s in sizes if s]) == 1 for sizes in shards.values())
    assert len({r["part"] for r in got if r["n_bytes"] == 50}) == 5  # 90 equal rows of 50 bytes, 20 to a part
    assert sharding.assign(df.limit(0)).count() == 0


def test_shards_are_written_whole(spark, tmp_path):
    rows = [(i, "z" * (i % 40)) for i in range(200)] + [(7, "same text")] * 150
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    sharding.write_shards(df, str(tmp_path / "shards"), limit=500)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == sorted(rows)
    sizes = back.groupBy("bits", "part").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.where("n > 500").count() == 0
