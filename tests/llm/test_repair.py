import hashlib
import random
import re
import zlib
from functools import lru_cache

from panelweave.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, gone string, copy string, fault string, nth string"


def best(rows):
    """(cost, audit, lines) by trying every edit; rows are (role, text, fault)."""

    @lru_cache(None)
    def solve(i, state, inserted):
        """At most three inserts in a row: more never help."""
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        name = "user" if after == 2 else "assistant"
        if inserted < 3:
            cost, audit, lines = solve(i, after, inserted + 1)
            found.append((cost + 2, "I" + audit, (name + ":", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = solve(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                late = int(fault == "truncated")
                kept = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(role[:1])
                if kept:
                    cost, audit, lines = solve(i + 1, kept, 0)
                    found.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = solve(i + 1, after, 0)
                found.append((cost + 2 + late, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    return solve(0, 0, 0)


def expected(rows, damage):
    """Naive result of each conversation from (conv_id, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 5
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        cost, audit, lines = best(tuple(judged))
        counts = [sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    rnd = random.Random(8)
    texts = ["Hi.", "What?", "no end", " ", "", None, "So! \n", "a.b", "x"]
    rows = []
    for conv in range(150):
        for turn in range(rnd.randrange(1, 11)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            if rnd.random() < 0.7:
                role = ("user", "assistant")[turn % 2]
            text = rnd.choice(texts) if rnd.random() < 0.5 else f"Text {rnd.random()}."
            rows.append((conv, None if rnd.random() < 0.05 else turn * rnd.choice([1, 1, 2]), role, text))
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, "assistant", "b.")]
    rows += [(500, 3, "user", "long " * 50_000 + "."), (501, 0, "user", "é?"), (501, 0, "user", "é?")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", "c", "f", "n") for r in rows], SCHEMA)


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_equals_trying_every_edit(spark):
    rows = conversations()
    assert got(repair.repair(frame(spark, rows))) == expected(rows, False)


def test_query_equals_trying_every_edit(spark, tmp_path):
    rows = conversations()
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert got(repair.op11_conversation_repair(spark, str(tmp_path))) == expected(rows, True)


def test_all_rows_dropped_and_empty_table(spark):
    drop = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    found = got(repair.repair(repair.damaged(frame(spark, [(drop, 0, "user", "a.")])), gone="gone"))
    assert found == {drop: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.repair(frame(spark, [])).collect() == []


def test_blocks_of_any_length_give_the_same_edits():
    rnd = random.Random(5)
    of = [repair.Tables(k) for k in (1, 2, 3, 4)]
    for _ in range(200):
        symbols = [rnd.randrange(9) for _ in range(rnd.randrange(30))]
        assert len({str(t.trace(symbols, repair.START, 0)) for t in of}) == 1


def test_long_conversation_is_written_as_it_is_read(monkeypatch):
    rnd = random.Random(6)
    tables, rows = repair.Tables(), []
    for k in range(3000):
        rows.append((rnd.choice(["user", "assistant", "system", "x"]), f"t{k}", rnd.choice(["", "", "blank", "truncated"])))
    whole, pieces = repair._Conversation(tables, 1), None
    for k, row in enumerate(rows):
        whole.add(k, *row)
    monkeypatch.setattr(repair, "WAITING", 16)
    pieces, most = repair._Conversation(tables, 1), 0
    for k, row in enumerate(rows):
        pieces.add(k, *row)
        most = max(most, len(pieces.rows))
    assert whole.close() == pieces.close()
    assert most < 100
