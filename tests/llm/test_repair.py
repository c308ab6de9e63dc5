"""Conversation repair beside a search through every sequence of edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rushline.llm import queries, repair
from rushline.llm.common import table

LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else
                   "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_edit(rows):
    """Cheapest edits by trying all of them, with at most two inserts at a place."""
    choices = []
    for (role, text), fault in zip(rows, faults(rows)):
        late = 5 * (fault == "truncated")
        own = [("D", 2, [])]
        if fault not in ("blank", "duplicate"):
            own += [("K", late, [(role, text)])]
            own += [("R", 1 + late, [(to, text)]) for to in ("user", "assistant")]
        choices.append(own)
    inserts = [("", 0, [])] + [("I", 5, [(r, "")]) for r in ("user", "assistant")] + [
        ("II", 10, [(a, ""), (b, "")]) for a in ("user", "assistant") for b in ("user", "assistant")]
    slots = [inserts]
    for own in choices:
        slots += [own, inserts]
    best = None
    for picks in itertools.product(*slots):
        cost = sum(c for _, c, _ in picks)
        if best and cost > best[0]:
            continue
        turns = [t for _, _, ts in picks for t in ts]
        if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in turns)):
            found = (cost, "".join(a for a, _, _ in picks), [f"{r}:{t}" for r, t in turns])
            best = min(best or found, found)
    return best


def by_prefixes(rows):
    """Cheapest edits by whole paths for every state: plain, and quick enough for long tables."""
    flows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    forced = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserted(paths):
        for _ in range(2):
            for state, (cost, audit, turns) in list(paths.items()):
                to = forced[state][0]
                found = (cost + 5, audit + "I", [*turns, (forced[state], "")])
                if to not in paths or found[:2] < paths[to][:2]:
                    paths[to] = found
        return paths

    paths = {"": (0, "", [])}
    for (role, text), fault in zip(rows, faults(rows)):
        new = {}

        def offer(state, found):
            if state not in new or found[:2] < new[state][:2]:
                new[state] = found

        late = 5 * (fault == "truncated")
        for state, (cost, audit, turns) in inserted(paths).items():
            offer(state, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] in flows[state]:
                offer(role[:1], (cost + late, audit + "K", [*turns, (role, text)]))
            offer(forced[state][0], (cost + 1 + late, audit + "R", [*turns, (forced[state], text)]))
        paths = new
    ends = inserted(paths)
    cost, audit, turns = min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])
    return cost, audit, [f"{r}:{t}" for r, t in turns]


def searched(rows, begin=repair.START, collect=3):
    search, edits = repair.Search(begin), []
    for i, ((role, text), fault) in enumerate(zip(rows, faults(rows))):
        search.feed(role[:1], fault, role, text)
        if i % collect == 0:
            edits += search.decided()
    cost = search.close()
    edits += search.decided()
    return cost, "".join(e[0] for e in edits), [f"{r}:{t}" for _, r, t in edits if r is not None]


ROLES = ["system", "user", "assistant", "tool", " ", "user", "assistant"]
TEXTS = ["one.", "two!", "three", "", " \n", "four?", "five. "]


def random_rows(rng, n):
    return [(rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < .6 else f"{rng.random()}.")
            for _ in range(n)]


def test_search_equals_trying_everything():
    rng = random.Random(1)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 4))
        assert searched(rows) == every_edit(rows) == by_prefixes(rows)


def test_search_equals_whole_paths():
    rng = random.Random(2)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(0, 60))
        assert searched(rows) == by_prefixes(rows)
    ties = [("user", f"{i}.") for i in range(400)]
    assert searched(ties) == by_prefixes(ties)


def test_undecided_paths_leave_the_tree():
    """A regular conversation of 50,000 rows never holds more than a few nodes."""
    search, held, edits = repair.Search(), 0, 0
    for i in range(50_000):
        role = ("user", "assistant")[i % 2]
        search.feed(role[0], "", role, "x.")
        edits += len(search.decided())
        nodes = set()
        for *_, node in search.alive.values():
            while node is not None and node is not search.root:
                nodes.add(id(node))
                node = node.parent
        held = max(held, len(nodes))
    assert held < 20 and edits > 49_900


def plain_digest(rows):
    """rows: (conv_id, turn, role, text); the contract in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        left = convs.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        left += [(turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    out = []
    for conv, left in convs.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, *_ in left if t is not None]
        body = [r[1:] for r in left]
        kinds = faults(body)
        cost, audit, turned = by_prefixes(body)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(body, body[1:])),
            cost, audit, hashlib.sha256("\n".join(turned).encode()).hexdigest()))
    return sorted(out, key=repr)


def digest(df, tasks=None):
    parts = repair.sorted_parts(repair.with_faults(repair.damage(df)), tasks)
    return sorted((tuple(r) for r in repair.digest(parts).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, segment string, fault string, alive string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def test_special_cases(spark):
    rows = [(None, 1, "user", "a."), (None, None, None, None), (1, None, "user", "Hi."),
            (1, None, "user", "Hi."), (1, 3, "assistant", None), (2, 7, None, "x" * 300_000 + "."),
            (3, 1, "", ""), (4, 5, "system", "ok.")]
    rows += [(5, 2, "user", "same."), (5, 2, "user", "same."), (5, 2, "assistant", "same.")]
    # conversations that lose all their rows
    rows += [(c, 0, "user", "gone.") for c in range(100, 200)]
    for tasks in (None, 1, 7):
        assert digest(made(spark, rows), tasks) == plain_digest(rows)
    assert any(r[7] == "" for r in plain_digest(rows))
    assert digest(made(spark, [])) == []


@pytest.mark.parametrize("tasks", [1, 13])
def test_one_conversation_in_many_tasks(spark, tasks):
    rng = random.Random(5)
    rows = [(9, i, *r) for i, r in enumerate(random_rows(rng, 3000))]
    rows += [(8, i, "user", f"{i}.") for i in range(900)]
    rows += [(c, t, *r) for c in range(40) for t, r in enumerate(random_rows(rng, 9)) if c not in (8, 9)]
    rng.shuffle(rows)
    df = made(spark, rows)
    assert digest(df, tasks) == plain_digest(rows)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_digest(rows)
