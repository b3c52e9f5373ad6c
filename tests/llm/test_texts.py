"""Tokens, repairs and survivors against the libraries and brute force."""

from __future__ import annotations

import base64
import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from labelmill.llm import mojibake, survivors, transducer
from labelmill.llm.queries import _clean

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def known():
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=transducer.PATTERN, mergeable_ranks=ranks, special_tokens={})


PATH = transducer.default_path()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab \n\r\x1c\x85\u00a0\u3000-'t1é中🙈", max_size=80)))
def test_ids_equal_the_library(text):
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        pass
    got = transducer.transducer(PATH).encode(text)
    assert list(got) == _library().encode_ordinary(text) and transducer.decode(got, PATH) == text


_CACHE: list = []


def _library():
    if not _CACHE:
        with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CACHE.append(tiktoken.Encoding("own", pat_str=transducer.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _CACHE[0]


def test_long_words_and_special_strings(known):
    t = transducer.transducer(PATH)
    for text in ("a" * 30_000, "ab" * 9_000, "<|endoftext|>", " " * 5000, "é" * 4000, "\x00 " * 50):
        assert list(t.encode(text)) == known.encode_ordinary(text) and t.count(text) == len(t.encode(text))


def test_stream_emits_the_same_ids_with_bounded_delay(known):
    t = transducer.transducer(PATH)
    word = "internationalizationalistically"
    seen = []
    sent = 0

    def pieces():
        nonlocal sent
        for b in word.encode():
            sent += 1
            yield bytes([b])

    for token in t.read(pieces()):
        seen.append((token, sent))
    assert [x for x, _ in seen] == known.encode_ordinary(word) and seen[0][1] < len(word)


def test_lookahead_and_states_do_not_grow_with_the_word(known):
    """The delay of every token of long words stays below the length of the longest token."""
    t = transducer.Transducer(transducer.Vocabulary.from_file(PATH))
    longest = max(map(len, t.vocabulary.ids))
    rng = random.Random(4)
    for word in ("ab" * 4000, "".join(rng.choice("etaoinshrdlu") for _ in range(5000)), "é中🙈" * 700, "=" * 3000):
        data, sent, done = word.encode(), 0, 0
        late, ids = 0, []

        def pieces():
            nonlocal sent
            for b in data:
                sent += 1
                yield bytes([b])

        for token in t.read(pieces()):
            ids.append(token)
            done += len(t.vocabulary.bytes[token])
            late = max(late, sent - done)
        assert ids == known.encode_ordinary(word) and late <= longest
        assert all(len(rest) <= longest for rest in t.rests)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=6))
def test_utf8_reader_equals_the_decoder(parts):
    reader = transducer.Utf8Reader()
    assert "".join(map(reader.feed, parts)) + reader.close() == b"".join(parts).decode("utf-8", "replace")


def test_texts_of_a_table(spark):
    df = spark.createDataFrame([(1, "", "x"), (2, None, None), (None, " hello", "y")], "ids long, text string, n_tokens string")
    got = {r["ids"]: r["ids_"] for r in transducer.encode_texts(df, "text", ["ids"]).collect()}
    assert got == {1: [], 2: [], None: [23748]}
    assert sorted(r["n_tokens_"] for r in transducer.count_tokens(df, "text", ["n_tokens"]).collect()) == [0, 0, 1]
    assert all(r["same"] for r in transducer.check_round_trip(df, "text", ["ids"]).collect())
    assert transducer.encode_texts(df.filter("false"), "text", ["ids"]).count() == 0


# ---- problem 8

CLEAN = [
    "Die Zählung für Zellen läuft über Nacht, höher als üblich – wie gewählt.", "Le témoin a été réglé à 25 °C, près du gène épissé.", "La célula está más allá; señal débil según el técnico.",
    "Add 20 µl of buffer — that’s all; “spliced” reads ≤ 5 % and α = 0.3.", "Порог качества выбран, чтобы ошибки чтения не считались меткой.", "A medição não é confiável: só 5 leituras até amanhã.",
]
MEANT = ["Â with a hat denotes the complement, Ã with a tilde the other.", "The exporter wrote &eacute; and &micro; instead.", "Move it to the «Îlot Âge» freezer.", "note that ¬converged ≠ failed ├── old 👍"]


def corpus():
    rng = random.Random(1)
    out = [" ".join(rng.sample(CLEAN, 3)) + f" {i}" for i in range(400)]
    return out + [m + f" {i}" for m in MEANT for i in range(8)]


WRONG = [("utf-8", "cp1252"), ("utf-8", "mac-roman"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("cp1252", "mac-roman"), ("mac-roman", "cp1252"), ("cp1252", "cp437"), ("utf-8", "gb18030"), ("utf-8", "latin-1")]


def test_texts_read_in_a_wrong_encoding_are_found_and_restored(spark):
    rows, want = [(i, t) for i, t in enumerate(corpus())], {}
    for i, (written, read) in enumerate(WRONG):
        for j in (0, 1, 2):
            good = f"{CLEAN[j]} {900 + 10 * i + j}".replace("–", "-").replace("à", "a")
            try:
                bad = good.encode(written).decode(read)
            except UnicodeError:
                continue
            rows.append((1000 + 10 * i + j, bad))
            want[1000 + 10 * i + j] = good
    twice = "für höher".encode().decode("cp1252").encode().decode("cp1252")
    rows += [(5000, twice + " 77"), (5001, "Gr��ere Zellen"), (5002, None), (5003, ""), (5004, "  \n "), (5005, "&Acirc;&micro;l")]
    want |= {5000: "für höher 77"}
    df = spark.createDataFrame(rows, "doc_id long, restored string").repartition(3)
    got = {r["doc_id"]: r for r in mojibake.repair_texts(df, "restored", ["doc_id"]).collect()}
    assert len(got) == len(rows)
    found = {k for k, r in got.items() if r["garbled"]}
    assert found == set(want) | {5001, 5005}
    assert not got[5001]["complete"] and got[5002]["restored"] is None and got[5003]["restored"] == ""
    right = sum(got[k]["restored"] == v for k, v in want.items())
    assert right >= 0.9 * len(want)


def test_the_filter_of_stretches_misses_none(spark):
    """One search for each distinct stretch finds what searching in every document finds."""
    rng = random.Random(3)
    rows = [(i, t.encode().decode("cp1252", "replace") if rng.random() < 0.1 else t) for i, t in enumerate(corpus())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shapes = mojibake.distinct_shapes(df, "text")
    model, letters = mojibake.learn(shapes)
    alone = mojibake.Repairer(model, letters)
    found = mojibake.outcomes(shapes, lambda: mojibake.Repairer(model, letters))
    marked, common = mojibake.marked_bits(found), mojibake.common_outcomes(found)
    assert common and all(alone.search(s) == out for s, out in common.items())
    paths = {r["shape"]: alone.search(r["shape"])[0] for r in shapes.collect()}
    assert all(mojibake.is_marked(marked, s) for s, path in paths.items() if path) and any(paths.values())
    assert sum(mojibake.is_marked(marked, s) for s, path in paths.items() if not path) <= 1
    got = {r["doc_id"]: (r["garbled"], r["restored"], r["complete"]) for r in mojibake.repair_texts(df, "text", ["doc_id"]).collect()}
    assert got == {i: alone.repair(t) for i, t in rows}


def test_places_of_single_characters_and_pairs_agree():
    text = "a\u00e9\u4e2d\U0001f648 z"
    one, two = mojibake._slots(mojibake._codes(text))
    framed = f" {text} "
    for k, m in enumerate(mojibake.MULTIPLIERS):
        assert one[k].tolist() == [mojibake._slot(ord(c), m, mojibake.SINGLE_BITS) for c in framed]
        assert two[k].tolist() == [mojibake._slot(ord(a) << 21 | ord(b), m, mojibake.PAIR_BITS) for a, b in zip(framed, framed[1:])]


def test_lost_bytes_are_put_back_from_what_they_left():
    forms = mojibake.lossy_forms("\u0444\u2019\u2265\u00e0")
    assert ("\u00d1", "\u0444") in forms["\u00d1"] and ("\u00c3", "\u00e0") in forms["\u00c3"]
    assert ("\u922e\ufffd", "\u2265") in forms["\u922e"]


def test_replacement_characters_are_guessed_where_that_is_sure(spark):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(9000, "h\ufffdher und f\ufffdr 1"), (9001, "\ufffd"), (9002, "plain \ufffd text")]
    got = {r["doc_id"]: r for r in mojibake.repair_texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"]).collect()}
    assert got[9000]["garbled"] and not got[9000]["complete"] and got[9000]["restored"].startswith("h\u00f6her")


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mojibake.repair_texts(empty, "text", ["doc_id"]).count() == 0


def test_copies_of_a_garbled_text_do_not_make_it_plausible(spark):
    bad = "Zählung für höher".encode().decode("cp1252")
    rows = list(enumerate([*corpus(), *[bad] * 300]))
    got = mojibake.repair_texts(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"])
    assert got.filter("garbled").count() == 300


# ---- problem 5

AT = [dt.datetime(2031, 1, d) for d in range(1, 10)]
ROWS = "barcode string, umi string, gx string, read_id string, aln_index int, velocity string, transcriptome boolean, score int, loaded_at timestamp, n_rows int"


def molecules(df, **more):
    order = [F.when(F.col("transcriptome"), 0).when(~F.col("transcriptome"), 1).otherwise(2), F.col("score").isNull(), -F.coalesce("score", F.lit(0)), F.col("read_id")]
    return survivors.best_representatives(df, {k: F.col(k) for k in ("barcode", "umi", "gx")}, order, ["read_id", "n_rows"], ["velocity", "score"], ["velocity"], "loaded_at", **more)


def row(umi, read_id, velocity=None, transcriptome=None, score=None, at=None):
    return ("b", umi, "g", read_id, 1, velocity, transcriptome, score, AT[at] if at is not None else None, 7)


def test_survivors_and_their_gaps(spark):
    learn = [row(f"l{i}", r, v, True, 1, t) for i in range(4) for r, v, t in (("a", "unassigned", 0), ("b", "spliced", 1))]
    rows = [
        *learn,
        row("u", "x", None, True, 3, 5), row("u", "y", "spliced", False, 9, 2), row("u", "z", "unassigned", False, 9, 3),  # times decide
        row("v", "x", None, True, None, 5), row("v", "y", "unassigned", False, 9), row("v", "z", "spliced", False, 4),  # no times: precedence
        row("w", "x", None, True, 3, 5), row("w", "y", "unassigned", False, 9, 2), row("w", "z", "spliced", False, 1),  # one undated, later by precedence
        row("one", "x", "spliced", True, 3, 5), row(None, "x"), row(None, "y"),
    ]
    got = {r["umi"]: r for r in molecules(spark.createDataFrame(rows, ROWS).repartition(3), least=2, support=3).collect()}
    assert set(got) == {"u", "v", "w", "l0", "l1", "l2", "l3"}
    assert all(got[u]["read_id"] == "x" for u in "uvw")
    assert [got[u]["velocity"] for u in "uvw"] == ["unassigned", "spliced", "spliced"]
    assert got["v"]["score"] == 9 and got["v"]["filled"] == ["velocity", "score"] and got["u"]["filled"] == ["velocity"]
    assert got["u"]["n_rows"] == 7 and got["u"]["n_rows_"] == 3
    assert molecules(spark.createDataFrame([], ROWS)).count() == 0


def test_precedence_has_no_cycles():
    closed = survivors.close_precedence({("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")})
    assert closed == {"a": {"b", "c", "d"}, "b": {"d"}, "c": {"d"}, "d": set()}
    currency = survivors.Currency("f", closed)
    assert [currency.depth(v) for v in currency.values] == [0, 1, 1, 3]


def test_transitions_are_those_between_neighbours(spark):
    """A group dated a, b, c moves from a to b and from b to c; noise and rare pairs give nothing."""
    rows = [row(f"m{i}", r, v, None, None, t) for i in range(6) for r, v, t in (("x", "a", 0), ("y", "b", 1), ("z", "c", 2), ("w", "b", 4))]
    rows += [row(f"n{i}", r, v, None, None, t) for i in range(10) for r, v, t in (("x", "d", i % 2), ("y", "e", 1 - i % 2))]
    rows += [row("rare", "x", "f", None, None, 0), row("rare", "y", "g", None, None, 1), row("same", "x", "a", None, None, 3), row("same", "y", "g", None, None, 3)]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    keys = [F.col(k) for k in ("barcode", "umi", "gx")]
    moved = {(r["a"], r["b"]): r["n"] for r in survivors.transitions(df, keys, ["velocity"], "loaded_at").collect()}
    assert moved == {("a", "b"): 6, ("b", "c"): 6, ("d", "e"): 5, ("e", "d"): 5, ("f", "g"): 1}
    learned = survivors.learn_currency(df, keys, ["velocity", "score"], "loaded_at", support=6)
    assert set(learned) == {"velocity"} and learned["velocity"].after == {"a": {"b", "c"}, "b": {"c"}, "c": set()}


def test_precedence_decides_within_a_group_only(spark):
    """The newest dated value gives way to undated ones that come after it, and to no others."""
    rows = [row(f"m{i}", r, v, True, 1, t) for i in range(4) for r, v, t in (("x", "a", 0), ("y", "b", 1), ("z", "c", 2))]
    rows += [row(f"n{i}", r, v, True, 1, t) for i in range(4) for r, v, t in (("x", "p", 0), ("y", "q", 1))]
    case = lambda umi, dated, *undated: [row(umi, "s", None, True, 9, 5), *([row(umi, "d", dated, False, 1, 3)] if dated else []), *[row(umi, f"u{v}", v, False, 1) for v in undated]]
    rows += case("1", "b", "a") + case("2", "a", "b", "c") + case("3", "a", "q") + case("4", None, "a", "q", "p") + case("5", None, "z") + case("6", "c", "b", "c") + case("7", "a", "c", "q")
    got = {r["umi"]: r["velocity"] for r in molecules(spark.createDataFrame(rows, ROWS), least=2, support=4).collect()}
    assert [got[u] for u in "1234567"] == ["b", "c", "a", "q", "z", "c", "c"]


def test_fields_that_are_no_categories_are_refused(spark, monkeypatch):
    rows = [row(f"m{i}", r, v, None, None, t) for i in range(9) for r, v, t in (("x", f"a{i % 3}", 0), ("y", f"b{i % 3}", 1))]
    df, keys = spark.createDataFrame(rows, ROWS), [F.col(k) for k in ("barcode", "umi", "gx")]
    assert len(survivors.learn_currency(df, keys, ["velocity"], "loaded_at", support=3)["velocity"].after) == 6
    monkeypatch.setattr(survivors, "MAX_PAIRS", 2)
    with pytest.raises(ValueError):
        survivors.learn_currency(df, keys, ["velocity", "score"], "loaded_at", support=3)


def test_survivors_query_equals_its_sql(spark, tmp_path):
    """With a precedence in the data, learned by either side."""
    import duckdb

    from labelmill.llm import queries

    rng = random.Random(2)
    stage = ["unassigned", "ambiguous", "unspliced", "spliced"]
    rows = []
    for i in range(900):
        for j in range(rng.choice([1, 2, 3, 5])):
            at = rng.choice([None, *range(8)])
            v = stage[min(3, (at if at is not None else rng.randrange(8)) // 2)] if rng.random() < 0.8 else rng.choice([None, *stage])
            rows.append((f"r{i}{j}", 1, f" c{i % 9}-1", f"u{i}", "g", 1, 2, 3, 4, v, rng.choice([True, False, None]), rng.choice([None, 3, 10]), dt.date(2031, 1, 1), j, AT[at] if at is not None else None))
    schema = "read_id string, aln_index int, barcode string, umi string, gx string, base_a int, base_c int, base_g int, base_t int, velocity string, transcriptome boolean, score int, run_day date, piece int, loaded_at timestamp_ntz"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/alignments.parquet")
    out = queries.p5_survivors(spark, str(tmp_path))
    got = sorted(map(repr, map(tuple, out.collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW alignments AS SELECT * FROM '{tmp_path}/alignments.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.SQL['p5_survivors']})").fetchall()
    assert got == sorted(map(repr, want)) and any("velocity" in r for r in got)
    keys = [F.col(k) for k in ("barcode", "umi", "gx")]
    assert "spliced" in survivors.learn_currency(spark.read.parquet(f"{tmp_path}/alignments.parquet"), keys, ["velocity"], "loaded_at")["velocity"].after["unassigned"]


def test_found_fills_gaps_that_its_columns_do_not_show(spark, tmp_path, monkeypatch):
    """p5_found learns the precedence, fills by it and looks at what was filled, even where rows are only counted."""
    import duckdb

    from labelmill.llm import queries

    schema = "read_id string, aln_index int, barcode string, umi string, gx string, base_a int, base_c int, base_g int, base_t int, velocity string, transcriptome boolean, score int, run_day date, piece int, loaded_at timestamp_ntz"
    line = lambda umi, read_id, velocity, score, at: (read_id, 1, "ACGT-1", umi, "g", 1, 2, 3, 4, velocity, True, score, dt.date(2031, 1, 1), 1, AT[at] if at is not None else None)
    rows = [line(f"m{i}", r, v, 1, t) for i in range(survivors.SUPPORT) for r, v, t in (("a", "unspliced", 0), ("b", "spliced", 1))]
    rows += [line("u", "x", None, 9, 5), line("u", "y", "unspliced", 1, None), line("u", "z", "spliced", 1, None), line("one", "x", None, 9, 5)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/alignments.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW alignments AS SELECT * FROM '{tmp_path}/alignments.parquet/*.parquet'")
    got = queries.p5_found(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.SQL["p5_found"]).fetchall()) and len(got) == survivors.SUPPORT + 1

    learned = {}

    def nothing(kind, currency, like):
        learned[like] = currency
        return F.lit(None).cast(kind)

    monkeypatch.setattr(survivors, "resolve_latest", nothing)
    with pytest.raises(Exception, match="not filled: velocity"):
        queries.p5_found(spark, str(tmp_path)).count()
    assert learned["f0"].after == {"unspliced": {"spliced"}, "spliced": frozenset()} and set(learned) == {"f0", "f1", "f2"}


def test_the_least_score_comes_before_none(spark, tmp_path):
    from labelmill.llm import queries

    schema = "read_id string, aln_index int, barcode string, umi string, gx string, velocity string, transcriptome boolean, score int, loaded_at timestamp_ntz"
    rows = [("a", 1, "ACGT", "u", "g", "spliced", True, None, AT[3]), ("b", 1, "ACGT", "u", "g", "spliced", True, -(2**31), None), ("c", 1, "ACGT", "u", "g", "spliced", True, -(2**31), AT[0])]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/alignments.parquet")
    assert [r["read_id"] for r in queries.p5_found(spark, str(tmp_path)).collect()] == ["c"]


def test_survivors_against_brute_force(spark):
    rng = random.Random(8)
    rows = [row(f"u{rng.randrange(40)}", f"r{i}", rng.choice([None, "spliced", "ambiguous"]), rng.choice([None, True, False]), rng.choice([None, 1, 2]), rng.choice([None, 1, 2])) for i in range(400)]
    got = {r["umi"]: r["read_id"] for r in molecules(spark.createDataFrame(rows, ROWS)).collect()}
    best = lambda x: ({True: 0, False: 1, None: 2}[x[6]], x[7] is None, -(x[7] or 0), x[3])
    want: dict = {}
    for x in rows:
        want[x[1]] = min(want.get(x[1], x), x, key=best)
    assert got == {u: x[3] for u, x in want.items()}


def test_clean_keys(spark):
    df = spark.createDataFrame([(" acgt-1 ",), ("NA",), ("-",), (None,), ("na ",), ("",)], "barcode string")
    assert [r[0] for r in df.select(_clean("barcode", suffix=True)).collect()] == ["ACGT", None, None, None, None, ""]
