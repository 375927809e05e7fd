import hashlib
import heapq
import random
import zlib

import pytest

from filings_audit.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, part string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def shortest(rows):
    """Cheapest edits by Dijkstra over (cost, letters); rows: (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, last, turns = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            return cost, letters, turns
        if (at, last) in done:
            continue
        done.add((at, last))
        wanted = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        full = {"u": "user", "a": "assistant"}
        for new in wanted.replace("s", ""):
            heapq.heappush(heap, (cost + 2, letters + "I", at, new, (*turns, (full[new], ""))))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 3, letters + "D", at + 1, last, turns))
        if fault in ("blank", "duplicate"):
            continue
        more = cost + (fault == "truncated")
        if role[:1] and role[:1] in wanted:
            heapq.heappush(heap, (more, letters + "K", at + 1, role[:1], (*turns, (role, text))))
        for new in wanted.replace("s", ""):
            heapq.heappush(heap, (more + 2, letters + "R", at + 1, new, (*turns, (full[new], text))))


def by_hand(rows):
    """The result of op11 for rows of (conv_id, turn, role, text)."""
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    groups = {}
    for conv, *row in damage(rows):
        groups.setdefault(conv, []).append(row)
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in group:
            rest = text.rstrip(SPACE)
            faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, *_ in group if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles = [role[:1] for _, role, _ in group]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, letters, repaired = shortest([(role, text, fault) for (_, role, text), fault in zip(group, faults)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, letters, digest)
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    frame.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_repair(spark, str(tmp_path)).collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in found}


def talk(r, conv, n, wild=0.5):
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t", "Fine. \n", "x" * 40 + ".", "été ."]
    roles = ["user", "assistant", "system", "tool", "", "umpire", None]
    out = [(conv, 0, "system", "Be kind.")] if r.random() < 0.3 else []
    for turn in range(n):
        role = r.choice(roles) if r.random() < wild else ["user", "assistant"][turn % 2]
        text = r.choice([*texts, None]) if r.random() < wild else f"{turn}."
        out.append((conv, None if r.random() < 0.05 else turn + r.randint(0, 2), role, text))
    return out


def test_against_dijkstra(spark, tmp_path):
    r = random.Random(8)
    rows = [row for conv in range(150) for row in talk(r, conv, r.randint(1, 14), r.choice([0, 0.2, 0.8]))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "user", "Hi."), (None, None, None, None), (-7, 3, "user", "Hi.")]
    r.shuffle(rows)
    wanted = by_hand(rows)
    assert run(spark, tmp_path, rows) == wanted
    assert len({row[5] for row in wanted.values()}) > 5


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_long_conversations_in_pieces(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(repair, "ROWS", 6)
    monkeypatch.setattr(repair, "PIECE", piece)
    r = random.Random(piece)
    rows = [row for conv in range(8) for row in talk(r, conv, 5 * conv, 0.6)]
    rows += [row for conv in (None, 99) for row in talk(r, conv, 120, 0.5)] + [(99, 5, "user", "Same.")] * 40
    assert run(spark, tmp_path, rows) == by_hand(rows)


def test_empty_table_and_all_rows_dropped(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == {}
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows = [(gone, 1, "user", "Hi.")]
    assert run(spark, tmp_path / "b", rows) == by_hand(rows) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_prices_are_exact_on_random_lattices():
    r = random.Random(2)
    for _ in range(300):
        rows = [(r.choice(["user", "assistant", "system", "tool"]), "x", r.choice(["", "", "truncated", "blank"])) for _ in range(r.randint(0, 70))]
        cost, letters = repair.cheapest([repair.code(role, fault) for role, _, fault in rows])
        assert (cost, letters) == shortest(rows)[:2]


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Data."), (1, 4, "user", "And")]
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)
    found, pieces = repair.repair(frame)
    row = found.first()
    assert (row.cost, row.audit, row.duplicate, row.truncated) == (8, "KDRD", 1, 1)  # keeping the last turn costs 8 as well, by KDRKI
    assert [tuple(t) for t in pieces.first().turns] == [("K", "user", "Hi."), ("R", "assistant", "Data.")]
