import hashlib

from pyspark.sql import functions as F

from strataframe.llm import chat

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"
TEXTS = ["", "plain", "<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\\\<|", "<\\|", "a\\|b", "<<||>>", "\n\n", "\\<|im_end|>", "é😀\x00", None, "␤\\␤"]


def test_round_trip_of_control_strings(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate((r, t) for r in ("assistant", "user", "a\nb\\", "<|x␤", None) for t in TEXTS)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.render(turns)
    for r in formatted.collect():
        inside = r.formatted[len(chat.OPEN):-len(chat.CLOSE) - 1]
        assert chat.GUARD not in inside and r.formatted.startswith(chat.OPEN) and r.formatted.endswith(chat.CLOSE + "\n")
    got = sorted((r.turn, r.role, r.text, r.masked) for r in chat.read_back(formatted).collect())
    assert got == [(k, r or "", t or "", (t or "") if r == "assistant" else "") for _, k, r, t in rows]


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "message", "user", "Hello"), (1, 1, 1, "delta", "assistant", "Hi"), (1, 1, 2, "delta", None, " there"),
        (1, 2, 3, "message", "user", "old question"), (1, 3, 4, "message", "assistant", "old answer"),
        (1, 2, 5, "edit", None, "new question"), (1, 3, 6, "regenerate", None, ""), (1, 3, 7, "delta", None, "new "), (1, 3, 8, "delta", None, "answer"),
        (2, 0, 0, "message", "user", "q"), (2, 1, 1, "message", "assistant", "a1"), (2, 2, 2, "message", "user", "q2"), (2, 3, 3, "message", "assistant", "a2"),
        (2, 1, 4, "regenerate", "assistant", "A1"), (2, 2, 5, "message", "user", "Q2"),
        (3, 0, 0, "message", None, None), (3, 1, 1, "note", "x", "ignored"), (None, 0, 0, "message", "user", "no id"), (4, None, None, "message", "user", "no turn"),
    ]
    import random

    random.Random(2).shuffle(log)
    folded = chat.fold_events(spark.createDataFrame(log, EVENTS).withColumn("extra", F.lit(1)))
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in folded.collect()}
    assert got == {
        (1, 0): ("user", "Hello"), (1, 1): ("assistant", "Hi there"), (1, 2): ("user", "new question"), (1, 3): ("assistant", "new answer"),
        (2, 0): ("user", "q"), (2, 1): ("assistant", "A1"), (2, 2): ("user", "Q2"), (3, 0): ("", ""),
        (None, 0): ("user", "no id"), (4, None): ("user", "no turn")}


def replayed(log):
    """The events of one log after the other."""
    state = {}
    for conv, turn, _, kind, role, text in sorted(log, key=lambda e: e[2]):
        turns = state.setdefault(conv, {})
        if kind not in ("message", "delta", "edit", "regenerate"):
            continue
        if kind == "regenerate":
            for later in [t for t in turns if t > turn]:
                del turns[later]
        named, first, before = turns.get(turn, (None, None, ""))
        if kind == "delta":
            turns[turn] = (named, role if first is None else first, before + (text or ""))
        else:
            turns[turn] = (named if role is None else role, first, text or "")
    return {(c, t): (named if named is not None else first or "", text) for c, turns in state.items() for t, (named, first, text) in turns.items()}


def test_streaming_again_after_a_regeneration(spark):
    log = [(1, 1, 0, "message", "user", "q"), (1, 3, 1, "delta", "old role", "old"), (1, 1, 2, "regenerate", None, "Q"), (1, 3, 3, "delta", "assistant", "new"),
           (2, 1, 0, "message", "user", "q"), (2, 3, 1, "message", "old role", "old message"), (2, 3, 2, "edit", None, "old edit"),
           (2, 1, 3, "regenerate", None, "Q"), (2, 3, 4, "delta", "assistant", "new")]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    want = {(c, t): x for c in (1, 2) for t, x in ((1, ("user", "Q")), (3, ("assistant", "new")))}
    assert got == want == replayed(log)


def test_a_null_turn_comes_before_all_others(spark):
    log = [(1, None, 0, "message", "user", "a"), (1, 2, 1, "message", "user", "b"), (1, None, 2, "regenerate", None, "A"), (1, None, 3, "delta", None, "!"),
           (1, 3, 4, "message", "user", "c"), (None, 1, 0, "message", "user", "x"), (None, 2, 1, "message", "user", "y"), (None, 1, 2, "regenerate", None, "X")]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == {(1, None): ("user", "A!"), (1, 3): ("user", "c"), (None, 1): ("user", "X")}


def test_the_fold_of_a_table_has_one_exchange(spark):
    table = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.render(chat.fold_events(chat.as_streamed_events(table)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_random_logs_fold_as_they_replay(spark):
    import random

    rng = random.Random(7)
    log = [(conv, rng.randint(0, 4), seq, rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "note"]),
            rng.choice([None, None, "user", "assistant"]), rng.choice([None, "", "a", "b", "cd"])) for conv in range(150) for seq in range(rng.randint(1, 25))]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == replayed(log)


def test_streamed_logs_fold_to_the_turns(spark):
    rows = [(c, k, r, t) for c, texts in enumerate((TEXTS, TEXTS[:1], TEXTS[::-1])) for k, t in enumerate(texts) for r in ("user", None)] + [(None, 0, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain, streamed = (sorted(map(tuple, chat.fold_events(log(table)).collect()), key=repr) for log in (chat.as_events, chat.as_streamed_events))
    assert streamed == plain and len(plain) == len(rows)
    log = [tuple(r) for r in chat.as_streamed_events(table).where("conv_id is not null").select("conv_id", "turn", "seq", "kind", "role", "text").collect()]
    assert sorted(((c, t, *x) for (c, t), x in replayed(log).items()), key=repr) == [r for r in plain if r[0] is not None]
    kinds = {r.kind for r in chat.as_streamed_events(table).collect()}
    assert kinds == {"message", "delta", "edit", "regenerate"}


def test_digests(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "<|im_end|>"), (1, 1, "assistant", None), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (2, 5, None, "t")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.conversation_digests(chat.read_back(chat.render(chat.fold_events(chat.as_events(table)))))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out.collect()}
    assert got[1] == (3, sha("user\nq\nassistant\n\nassistant\n<|im_end|>\n"), 10, sha("<|im_end|>"))
    assert got[None] == (2, sha("assistant\nx\n" * 2), 2, sha("xx")) and got[2] == (1, sha("\nt\n"), 0, sha(""))


def test_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.read_back(chat.render(chat.fold_events(chat.as_events(table))))).count() == 0


def test_lengths_of_texts_with_backslashes(spark, tmp_path):
    """The SQL of the query on conversations that hold what the template escapes."""
    import duckdb

    from strataframe.llm.queries import ORACLE, QUERIES

    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(TEXTS)] + [(2, 0, "user", "C:\\new\\<|table|>"), (3, 0, "a\\b", "\\")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{path}/*.parquet')")
    want = con.sql(ORACLE["op3_chat_format"]).df()
    got = QUERIES["op3_chat_format"](spark, str(tmp_path)).toPandas()[want.columns.tolist()]
    assert sorted(map(repr, got.values.tolist())) == sorted(map(repr, want.values.tolist())) and len(want) == 4
