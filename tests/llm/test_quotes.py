import pytest

from curbline.llm import quotes

SCHEMA = "msg_id long, text string, own string, thread_id int, source string"


def linked(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "o", 1, "s") for row in rows], SCHEMA).repartition(3)
    found = quotes.link(frame, **options).collect()
    assert len({r.msg_id for r in found}) == len(found)
    return {r.msg_id: (r.thread_id, r.parent_id, r.depth, r.n_quotes, r.n_found, r.own) for r in found}


def test_levels_and_paragraphs():
    text = "Hi\nOn Monday A wrote:\n> one\n> two\n>\n>> deep\n> > deep too\n>>> 3\n\nmine\nmine too\n\n\nlast"
    assert quotes.paragraphs(text) == [
        (0, "Hi"), (1, "one\ntwo"), (2, "deep\ndeep too"), (3, "3"), (0, "mine\nmine too"), (0, "last"),
    ]
    assert quotes.own_text(text) == "Hi\n\nmine\nmine too\n\n\nlast"
    assert quotes.paragraphs("") == [] and quotes.paragraphs("> \n>") == []


def test_nested_quotes_make_a_conversation(spark):
    rows = [
        (1, "First  message"),
        (2, "> first message\n\nAnswer"),
        (3, ">> FIRST message\n> answer\n\nMore"),
        (4, "> First message\n\nOther branch"),
        (5, "Alone"),
        (6, "> never written\n\nLost"),
        (7, ">> answer\n> never written\n\nOnly the older quote is known"),
    ]
    got = linked(spark, rows)
    assert {k: v[:5] for k, v in got.items()} == {
        1: (1, None, 0, 0, 0),
        2: (1, 1, 1, 1, 1),
        3: (1, 2, 2, 2, 2),
        4: (1, 1, 1, 1, 1),
        5: (5, None, 0, 0, 0),
        6: (6, None, 0, 1, 0),
        7: (1, 2, 2, 2, 1),
    }
    assert got[3][5] == "More" and got[6][5] == "Lost"


@pytest.mark.parametrize("block_rows", [1, 3, 50_000])
def test_the_last_earlier_message_is_the_source(spark, block_rows):
    rows = [(n, "Hello all") if n % 5 == 0 else (n, f"> hello all\n\nReply {n}") for n in range(60)]
    got = linked(spark, rows, block_rows=block_rows)
    for n in range(60):
        wanted = None if n % 5 == 0 else n - n % 5
        assert got[n][1] == wanted and got[n][0] == n - n % 5


def test_brute_force_on_random_mail(spark):
    import random

    draw = random.Random(8)
    passages = [f"passage {n}" for n in range(6)]
    rows = []
    for n in range(150):
        parts = ["> " + p for p in draw.sample(passages, draw.randrange(3))]
        parts += [">> " + p for p in draw.sample(passages, draw.randrange(2))]
        parts += draw.sample(passages, draw.randrange(2))
        rows.append((n * 7, "\n\n".join(parts)))
    got = linked(spark, rows, block_rows=10)
    parsed = {n: quotes.paragraphs(text) for n, text in rows}
    for n, text in rows:
        best = {}
        for level, passage in parsed[n]:
            sources = [m for m, _ in rows if m < n and (0, passage) in parsed[m]]
            if level and sources:
                best[level] = max(best.get(level, -1), max(sources))
        parent = best[min(best)] if best else None
        assert got[n][1] == parent
        assert got[n][2] == (got[parent][2] + 1 if parent is not None else 0)
        assert got[n][0] == (got[parent][0] if parent is not None else n)


def test_deep_chain(spark):
    rows = [(n, f"m{n}" if n == 0 else f"> m{n - 1}\n\nm{n}") for n in range(300)]
    got = linked(spark, rows)
    assert {v[0] for v in got.values()} == {0}
    assert [got[n][2] for n in range(300)] == list(range(300))


def test_nulls_repeats_and_empty(spark):
    got = linked(spark, [(1, None), (2, ""), (2, "b"), (3, "> b\n> c"), (None, "x"), (4, "> self\n\nself")])
    assert got == {
        1: (1, None, 0, 0, 0, ""),
        2: (2, None, 0, 0, 0, ""),
        3: (3, None, 0, 1, 0, ""),
        4: (4, None, 0, 1, 0, "self"),
    }
    assert linked(spark, []) == {}


def test_conversations_are_written_in_reply_order(spark, tmp_path):
    frame = spark.createDataFrame([(2, "> a\n\nb"), (1, "a"), (3, "z")], "msg_id long, text string")
    quotes.write_conversations(quotes.link(frame), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.thread_id, r.own) for r in sorted(rows, key=lambda r: (r.thread_id, r.msg_id))] == [
        (1, "a"), (1, "b"), (3, "z"),
    ]


def test_long_conversations_do_not_run_into_the_next(spark):
    """A turn above a million, or below none, has an id of its own."""
    million = quotes.TURNS
    rows = [(1, million + turn, f"one {turn}") for turn in range(3)] + [(2, turn, f"two {turn}") for turn in range(-2, 3)]
    mail = quotes.as_mail(spark.createDataFrame(rows, "conv_id long, turn int, text string"))
    got = quotes.link(mail).collect()
    assert len(got) == len(rows)
    assert sorted((r.own, r.depth) for r in got) == sorted((text, n if conv == 1 else n - 3) for n, (conv, _, text) in enumerate(rows))
    ids = {r.own: r.msg_id for r in got}
    roots = {(r.own.split()[0], r.thread_id) for r in got}
    assert roots == {("one", ids[f"one {0}"]), ("two", ids["two -2"])}


def test_short_conversations_keep_their_ids(spark):
    frame = spark.createDataFrame([(3, 0, "a"), (3, 7, "b")], "conv_id long, turn int, text string")
    assert sorted(r.msg_id for r in quotes.as_mail(frame).collect()) == [3_000_000, 3_000_007]
