import random
import re

from shoplark.llm import chat
from shoplark.llm.chat import ANNOUNCE, format_chats

SCHEMA = "conv_id long, turn long, role string, text string, position long, path string, units string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA)


def plain(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def split_levels(text):
    out = []
    for line in (text or "").split("\n"):
        m = re.match(r"[ \t]*((?:>[ \t]?)*)", line)
        out.append((m[1].count(">"), line[m.end() :]))
    return out


def units(lines):
    found = {(n, plain(w)) for n, w in lines}
    found |= {(k, plain(" ".join(w for n, w in lines if n == k))) for k in {n for n, _ in lines}}
    return {(n, w) for n, w in found if w}


def brute(rows):
    """{(conv, turn): (reply_to, n_quotes, n_linked)}, and the reply order of each conversation."""
    convs = {}
    for c, t, _, x in rows:
        convs.setdefault(c, {})[t] = units(split_levels(x))
    info, order = {}, {}
    for c, turns in convs.items():
        children, previous = {}, None
        for t in sorted(turns):
            links = [(n, max((s for s in turns if s < t and (0, w) in turns[s]), default=None)) for n, w in turns[t] if n]
            direct = [x for n, x in links if n == 1 and x is not None]
            some = [x for _, x in links if x is not None]
            to = max(direct) if direct else max(some) if some else None
            info[c, t] = (to, len(links), len(some))
            children.setdefault(to if to is not None else previous, []).append(t)
            previous = t
        out, stack = [], sorted(children.get(None, []), reverse=True)
        while stack:
            t = stack.pop()
            out.append(t)
            follow = [x for x in sorted(turns) if x > t][:1]
            # The message after goes on in the same branch, so it comes after the branches that begin here.
            kids = sorted(children.get(t, []))
            own = [k for k in kids if follow and k == follow[0]]
            stack += own + sorted((k for k in kids if k not in own), reverse=True)
        order[c] = out
    return info, order


def random_chats(rng, convs, turns):
    rows = []
    for c in range(convs):
        said = []
        for t in range(turns):
            lines = []
            if said and rng.random() < 0.6:
                k = rng.randrange(len(said))
                quote = rng.choice((said[k], said[k].split("\n")[0], said[k].replace("\n", " ").upper(), "never said"))
                if rng.random() < 0.3 and k:
                    lines += [">> " + x for x in said[k - 1].split("\n")]
                lines += [rng.choice(("> ", ">", "  > ")) + x for x in quote.split("\n")]
            own = f"line {rng.randint(0, 9999)} of {t},\n" * rng.randint(0, 1) + f"message {rng.randint(0, 99999)} ok" if rng.random() < 0.9 else "yes"
            rows.append((c, t * 3, "user" if t % 2 == 0 else "assistant", "\n".join([*lines, own])))
            said.append(own)
    rng.shuffle(rows)
    return rows


def check(spark, rows):
    got = format_chats(frame(spark, rows)).collect()
    info, order = brute(rows)
    assert len(got) == len(rows)
    assert {(r.conv_id, r.turn): (r.reply_to, r.n_quotes, r.n_linked) for r in got} == info
    for c, turns in order.items():
        assert [r.turn for r in sorted((r for r in got if r.conv_id == c), key=lambda r: r.position)] == turns
        assert sorted(r.position for r in got if r.conv_id == c) == list(range(len(turns)))
    assert not any(re.search(r"(?m)^\s*>", r.text) for r in got)


def test_links_and_order_equal_brute_force(spark):
    check(spark, random_chats(random.Random(3), 12, 12))


def test_small_spans_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN", 5)
    check(spark, random_chats(random.Random(8), 2, 40))


def test_texts_and_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"),
        (1, 1, "assistant", "On Monday A wrote:\n> hello THERE\n\nFine.\n\n\n\nAnd you?"),
        (1, 1, "assistant", "twin"),
        (1, 2, None, ">> Hello there. How\n>> are you?\n> Fine.\n"),
        (2, 0, "user", None),
        (2, 1, "user", ""),
        (None, 0, "user", "> lost"),
        (3, None, "user", "lost"),
    ]
    got = sorted(((r.conv_id, r.turn, r.text, r.reply_to, r.n_linked, r.position) for r in format_chats(frame(spark, rows)).collect()), key=str)
    assert (1, 1, "Fine.\n\nAnd you?", 0, 1) in [x[:5] for x in got]
    assert (1, 2, "", 1, 2, 3) in got
    assert [x[2] for x in got if x[0] == 2] == ["", ""]
    assert [x[5] for x in got if x[0] is None or x[1] is None] == [None, None]
    assert len(got) == len(rows)
    plain_rows = format_chats(frame(spark, [(1, 5, "u", "b"), (1, 2, "u", "a")])).orderBy("position").collect()
    assert [r.turn for r in plain_rows] == [2, 5] and plain_rows[0].message == "<|u|>\na"
    assert format_chats(frame(spark, [])).count() == 0
    assert re.match(ANNOUNCE, "Le 3 mai, B a écrit :")


def test_no_python_in_the_plan(spark):
    df = format_chats(frame(spark, random_chats(random.Random(1), 2, 4)))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_sql_agrees(spark):
    import duckdb

    from shoplark.llm.queries import ORACLES

    rows = random_chats(random.Random(21), 6, 14) + [(90, 0, None, None), (91, 3, "user", "On May 3 B wrote:\n> x y\nok")]
    duck = duckdb.connect()
    duck.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    duck.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    got = duck.sql(ORACLES["op10_chat_formatting"])
    want = sorted(got.fetchall())
    assert sorted(tuple(r[c] for c in got.columns) for r in format_chats(frame(spark, rows)).collect()) == want


def passages(lines, units=units):
    """All that a brute force takes for units: lines, levels, and the levels' runs and paragraphs without announcements."""
    told = [bool(re.match(ANNOUNCE, w)) and i + 1 < len(lines) and lines[i + 1][0] > n for i, (n, w) in enumerate(lines)]
    found = units(lines)
    for k in {n for n, _ in lines}:
        run, paragraph, whole = [], [], []
        for (n, w), out in [*zip(lines, told), ((-1, ""), False)]:
            inside = n == k and not out
            if not inside:
                found.add((k, plain(" ".join(run))))
                run = []
            if not inside or not plain(w):
                found.add((k, plain(" ".join(paragraph))))
                paragraph = []
            if inside:
                run.append(w)
                paragraph.append(w)
                whole.append(w)
        found.add((k, plain(" ".join(whole))))
    return {(n, w) for n, w in found if w}


def wrapped(words, width):
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def passage_chats(rng, convs, turns):
    rows = []
    for c in range(convs):
        said = []
        for t in range(turns):
            own = [[f"w{rng.randint(0, 999)}" for _ in range(rng.randint(5, 12))] for _ in range(3)]
            blocks = [wrapped(p, 4) for p in own]
            if said and rng.random() < 0.8:
                quotes = [re.sub("(?m)^", "> ", wrapped(p, 3)) for p in rng.choice(said)[: rng.randint(1, 3)]]
                style = rng.randrange(3)
                if style == 0:  # answers between
                    blocks = [x for i, b in enumerate(blocks) for x in (*quotes[i : i + 1], b)]
                elif style == 1:  # in one block of some paragraphs, announced
                    blocks = ["On Monday A wrote:\n" + "\n>\n".join(quotes), *blocks]
                else:  # below the answer, which a later quote cites without the announcement
                    blocks = [*blocks[:2], blocks[2] + "\nOn Monday A wrote:\n" + "\n".join(quotes)]
            rows.append((c, t, "user", "\n\n".join(blocks)))
            said.append(own)
    rng.shuffle(rows)
    return rows


def test_passages_equal_brute_force(spark, monkeypatch):
    monkeypatch.setitem(brute.__globals__, "units", passages)
    rows = passage_chats(random.Random(5), 8, 10)
    check(spark, rows)


def test_rewrapped_passages_are_linked(spark):
    rows = [
        (1, 0, "user", "One two three\nfour five.\n\nSix seven eight\nnine ten.\n\nLast of all\nparagraphs here."),
        (1, 1, "assistant", "Something else."),
        (1, 2, "user", "> One two\n> three four five.\nMy answer.\n> Six seven\n> eight nine ten.\nAnd another\nanswer to it."),
        (1, 3, "user", "Filler."),
        (1, 4, "user", "On Monday A wrote:\n> Something else.\nNow an answer\nof two lines."),
        (1, 5, "user", "More filler."),
        (1, 6, "user", "> Now an\n> answer of two lines.\nRight."),
        (1, 7, "user", "> Six seven\n> eight nine ten.\n>\n> Last of\n> all paragraphs here.\nYes."),
    ]
    got = {r.turn: (r.reply_to, r.n_linked > 0) for r in format_chats(frame(spark, rows)).collect()}
    assert got == {0: (None, False), 1: (None, False), 2: (0, True), 3: (None, False), 4: (1, True), 5: (None, False), 6: (4, True), 7: (0, True)}
