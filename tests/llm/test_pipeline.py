"""The stages that choose documents, on repeated rows, rows without an id and empty tables."""

import random
import re
import struct

import corpus_pipeline
import public_tokenizers
from starloom.llm import classifier, rules, tokens

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n=60):
    return " ".join(rng.choice(["the", "river", "and", "stone", "of", "window", "in", "harbour"]) for _ in range(n)) + "."


def table_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in texts], COLUMNS)


def test_one_row_is_left_of_each_group(spark):
    rng = random.Random(2)
    a, b, c, d = ([f"w{rng.randrange(5000)}" for _ in range(80)] for _ in range(4))
    near = lambda words: " ".join([*words[:-1], "other"])
    text = " ".join
    big = 2**60 + 1
    rows = [
        (3, text(a), "y"), (3, text(a), "x"), (3, text(a), "x"), (None, near(a), "x"),
        (None, text(b), "x"), (None, text(b), "x"), (None, near(b), "x"),
        (8, text(c), "x"), (8, text(d), "x"), (big, near(d), "x"), (big + 1, "of one kind", "x"),
        (20, "", "x"), (20, None, "x"), (21, " ", "x"),
    ]
    docs = table_of(spark, rows)
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    got = [(r["doc_id"], r["text"], r["source"]) for r in left.collect()]
    of_b = [r for r in got if r[0] is None]
    assert len(of_b) == 1 and of_b[0][1] in (text(b), near(b))
    wordless = [r[0] for r in got if not (r[1] or "").strip()]
    assert sorted(wordless) == [20, 21]
    assert sorted(r for r in got if r[0] not in (None, 20, 21)) == sorted([
        (3, text(a), "x"), (8, text(c), "x"), (8, text(d), "x"), (big + 1, "of one kind", "x"),
    ])
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").collect() == []


def test_classifier_judges_rows_not_ids(spark, tmp_path):
    rng = random.Random(3)
    junk = lambda: " ".join(rng.choice(["#$%", "BUY!!!", "777", "@@", "CLICK"]) for _ in range(60))
    rows = [(i, prose(rng) if i % 2 else junk(), "x") for i in range(80)]
    labels = [(i, i % 2, 0) for i in range(80)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good, bad = prose(rng), junk()
    rows += [(500, good, "x"), (500, bad, "x"), (None, good, "x"), (None, bad, "x"), (501, good, "x"), (501, good, "x")]
    docs = table_of(spark, rows)
    scored = classifier.score_documents(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), keep=("text",))
    assert scored.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    left = corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"]) for r in left.collect())
    assert got == sorted((str(i), t) for i, t, _ in rows if not ("BUY" in t or "#$%" in t))
    assert corpus_pipeline.quality_classifier(spark, docs.limit(0), str(tmp_path)).collect() == []


# ---- all stages against plain ones ------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(rng):
    """Good and bad texts, copies, near copies, repeated rows, rows without id, text or source."""
    good = lambda n=80: prose(rng, n) + " " + " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    junk = lambda: " ".join(rng.choice(["#$%", "BUY!!!", "777", "@@", "CLICK"]) for _ in range(60))
    rows = [(i, good() if i % 3 else junk(), f"s{i % 4}") for i in range(120)]
    a, b = good(), good()
    rows += [(200, a, "s1"), (201, a, "s0"), (202, a + " more", None), (200, a, "s1"), (None, b, "s2"), (None, b, "s2")]
    rows += [(300, None, "s0"), (301, "", None), (302, " \n", "s1"), (303, "too short", "s3"), (304, (a.split(" ")[0] + " ") * 400, "s3")]
    rows += [(305, " ".join(good(30) for _ in range(40)), "s2")]
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def near_groups(rows):
    """Positions of rows in groups of near-duplicates by five-word shingles, similarity 0.8."""
    sets = []
    for _, text, *_ in rows:
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group, sets


def test_stages_in_a_row_equal_plain_ones(spark, tmp_path):
    rng = random.Random(8)
    rows = corpus(rng)
    docs = table_of(spark, rows)
    sf_dir = str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = collected(kept)
        path = f"{sf_dir}/{name}"
        stage(spark, kept, sf_dir).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns, name
        after = collected(kept)
        if name == "quality_classifier":
            scored = classifier.score_documents(
                spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("text",)
            )
            verdict = {(r["doc_id"], r["text"]): r["predicted"] for r in scored.collect()}
            assert after == [r for r in before if verdict[r[0], r[1]] == 1]
            assert {0, 1} <= set(verdict.values())
        elif name == "quality_rules":
            judged = rules.judge(spark.createDataFrame(before, COLUMNS), keep=("text",)).collect()
            plain = {(r["doc_id"], r["text"]): r for r in judged}
            for r in before:
                n = len(words_of(r[1]))
                assert plain[r[0], r[1]]["counts"]["n_words"] == n
                assert not plain[r[0], r[1]]["kept"] or n >= 20
            assert after == [r for r in before if plain[r[0], r[1]]["kept"]]
        elif name == "near_duplicates":
            group, sets = near_groups(before)
            left = list(after)
            for g in set(group):
                mine = [before[k] for k in range(len(before)) if group[k] == g and sets[k]]
                assert not mine or sum(r in mine for r in left) == 1, mine
            assert set(after) <= set(before)
        elif name == "source_mix":
            size = lambda found: sum(len(words_of(r[1])) for r in found)
            sources = sorted({r[3] for r in before}, key=lambda s: (s is None, s or ""))
            total, target = size(before), {}
            open_ = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
            rest = float(total)
            while open_:
                share = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
                over = [s for s in open_ if share[s] > 3 * size([r for r in before if r[3] == s])]
                if not over:
                    target |= share
                    break
                for s in over:
                    target[s] = 3 * size([r for r in before if r[3] == s])
                    rest -= target[s]
                    del open_[s]
            for s in sources:
                assert abs(size([r for r in after if r[3] == s]) - target[s]) <= 3, s
            for key in {r[0] for r in after}:
                assert sum(r[0] == key for r in after) <= 3 * sum(r[0] == key for r in before)
    pieces = corpus_pipeline.packing_stage(spark, kept, sf_dir).collect()
    check_pieces(pieces, collected(kept))
    check_pieces(corpus_pipeline.run(spark, sf_dir).collect(), collected(kept))


def check_pieces(pieces, docs):
    """Sequences without gaps and padding, from whose pieces the documents' ids come back."""
    tokenizer = tokens.load(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(struct.pack(f"<{len(ids)}I", *ids) for ids in (
        [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in docs
    ))
    places = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        places.setdefault(p["sequence_id"], []).append((p["offset"], p["length"], p["sequence_length"]))
    for found in places.values():
        at = 0
        for offset, length, whole in sorted(found):
            assert offset == at
            at += length
        assert at == whole and whole & (whole - 1) == 0 and whole <= 2048
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["ids"]))
    total = {}
    for (key, size), found in by_doc.items():
        # copies of a document give each of its parts as often
        covered = sum(len(ids) // 4 for _, ids in found)
        assert covered % size == 0
        total[key] = total.get(key, 0) + covered // size
    assert sum(total.values()) == len(want)
    assert sum(p["length"] for p in pieces) == sum(len(w) // 4 for w in want)
    texts = b"".join(sorted(want))
    assert all(p["ids"] in texts for p in pieces)


def test_stages_take_empty_tables(spark, tmp_path):
    rng = random.Random(8)
    none = table_of(spark, corpus(rng)).limit(0)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == [], name
