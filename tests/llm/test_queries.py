from collections import defaultdict

import pytest

from tessella.llm import leakage, queries
from tessella.llm import runs as rn

ORACLE = queries.oracle()


def alike(rows, duck):
    """The same by agglomerating each utterance's tokens as one list."""
    sql = queries._RUNS_SQL.split("cut AS")[0].rstrip().rstrip(",") + " SELECT dataset, stem, token_id, start_s, end_s, key FROM keyed ORDER BY dataset, stem, start_s, token_id"
    tokens = defaultdict(list)
    for dataset, stem, i, a, b, key in duck.execute(sql).fetchall():
        tokens[dataset, stem].append(rn.Run(i, i, a, b, 1, (key,)))
    want = {(*u, r.first_id, r.last_id, r.n) for u, ts in tokens.items() for r in rn.agglomerate(ts, 0.75, 2.0) if r.n > 1}
    return {(r["dataset"], r["stem"], r["first_id"], r["last_id"], r["n"]) for r in rows} == want


def packed(rows, duck):
    """Every document once and whole, no container too full, few not full."""
    (docs,) = duck.execute("SELECT count(DISTINCT doc_id) FROM documents").fetchone()
    pieces, held = defaultdict(list), defaultdict(int)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["from_token"], r["to_token"]))
        held[r["container"]] += r["n_tokens"]
    whole = all(p[0][1] == 0 and all(a[2] == b[1] for a, b in zip(p, p[1:], strict=False)) for p in map(sorted, pieces.values()))
    return len(pieces) == docs and whole and max(held.values()) <= 2048 and len(held) <= sum(held.values()) / 2048 * 1.03 + 2


def room(rows, duck):
    return {r["capacity"] for r in rows} == {512, 1024, 2048, 4096, 8192} and all(r["tokens"] <= r["containers"] * r["capacity"] and r["containers"] <= r["tokens"] / r["capacity"] * 1.02 + 2 for r in rows)


def _shared(duck):
    """Share of each item's wording in stretches of three tokens that each document holds too, all against all."""
    docs, items = (duck.execute(q).fetchall() for q in ("SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL", "SELECT item_id, text FROM eval_item WHERE text IS NOT NULL"))
    cut = lambda text: (names := leakage.tokens([text]).name.tolist(), [tuple(names[i : i + 3]) for i in range(len(names) - 2)])
    known = {i: cut(t) for i, t in items}
    for doc, text in docs:
        own = set(cut(text)[1])
        for i, (names, threes) in known.items():
            covered = {k for n, x in enumerate(threes) if x in own for k in (n, n + 1, n + 2)}
            yield doc, i, len(covered) / max(1, len(names))


def leaked(rows, duck):
    """What is found shares most of its wording; what shares nearly all of it is found."""
    share = {(d, i): s for d, i, s in _shared(duck)}
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    return all(share[p] >= 0.4 for p in found) and {p for p, s in share.items() if s >= 0.9} <= found


def items(rows, duck):
    (n,) = duck.execute("SELECT count(*) FROM eval_item").fetchone()
    return len(rows) == n and any(r["documents"] for r in rows) and all((r["share"] >= 0.5) == (r["documents"] > 0) for r in rows)


def stats(rows, duck):
    """Every document with a text once; the kinds agree with nearly all ratings on which raters agree."""
    (n,) = duck.execute("SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL").fetchone()
    rated = dict(duck.execute("SELECT doc_id, min(kind) FROM doc_label GROUP BY 1 HAVING count(DISTINCT kind) = 1").fetchall())
    kinds = {r["doc_id"]: r["kind"] for r in rows}
    hits = [(kinds[d] == "prose") == (k == "prose") for d, k in rated.items() if d in kinds]
    return len(rows) == len(kinds) == n and sum(hits) >= 0.8 * len(hits)


def not_prose(rows, duck):
    (n,) = duck.execute("SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL").fetchone()
    return list(rows[0]) == ["doc_id"] and len({r["doc_id"] for r in rows}) == len(rows) < 0.5 * n


HOLDS = {"p5_alike": alike, "p6_packed": packed, "p6_room": room, "p7_found": leaked, "p7_items": items, "p8_found": not_prose, "p8_stats": stats}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(name, agree):
    assert agree(queries.QUERIES[name], ORACLE.get(name), HOLDS.get(name))
