import hashlib
import random
import re

from pagemill.llm import line_dedup as ld


def brute(rows, gram=25, window=50):
    """Kept text and removed lines per document, by the definition."""
    docs = {}
    for d, t in rows:
        docs[(d is None, d or 0, t or "")] = [
            (i, hashlib.md5(re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").encode()).hexdigest(),
             len(re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").split(" ")))
            for i, x in enumerate((t or "").split("\n")) if re.sub(r"[\x20\x09-\x0D]+", "", x)]

    def stretch(ls, i, words):
        n = 0
        for j in range(i, len(ls)):
            n += ls[j][2]
            if n >= words:
                return j
        return None

    marks = {}
    for key in sorted(docs):
        ls = docs[key]
        for i in range(len(ls)):
            end = stretch(ls, i, window)
            if end is None:
                continue
            best = min(((hashlib.md5("".join(x[1] for x in ls[k:e + 1]).encode()).hexdigest(), k)
                        for k in range(i, end + 1) for e in [stretch(ls, k, gram)] if e is not None and e <= end), default=None)
            if best and (key, best[1]) not in marks.setdefault(best[0], []):
                marks[best[0]].append((key, best[1]))
    gone = {k: set() for k in docs}
    for places in marks.values():
        places.sort()
        c, q = places[0]
        for d, p in places[1:]:
            own, other, s = docs[d], docs[c], p - q
            a = b = p
            while a > 0 and a - 1 - s >= 0 and own[a - 1][1] == other[a - 1 - s][1]:
                a -= 1
            while b + 1 < len(own) and b + 1 - s < len(other) and own[b + 1][1] == other[b + 1 - s][1]:
                b += 1
            gone[d].add((a, b))
    out = []
    for d, t in rows:
        key = (d is None, d or 0, t or "")
        ls = docs[key]
        drop = {k for a, b in gone[key] for k in range(a, b + 1)}
        lines, spans = (t or "").split("\n"), [(ls[a][0], ls[b][0]) for a, b in gone[key]]  # with the blank lines inside
        kept = "\n".join(x for i, x in enumerate(lines) if not any(a <= i <= b for a, b in spans))
        out.append((d, None if t is None else kept, len(drop)))
    return out


def line(rng, n):
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


def rows_of(seed):
    rng = random.Random(seed)
    pool = [line(rng, rng.choice([3, 8, 20, 30, 60, 90])) for _ in range(25)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(1, 9)):
            if rng.random() < 0.5:
                k = rng.randrange(len(pool))
                own += pool[k:k + rng.randrange(1, 5)]
            else:
                own.append(line(rng, rng.choice([2, 15, 40])))
            if rng.random() < 0.2:
                own.append(rng.choice(["", "  ", "\t"]))
        rows.append((i, "\n".join(own)))
    return rows


def test_matches_brute_force(spark):
    rng = random.Random(9)
    hot = line(rng, 55)
    rows = rows_of(1) + [(1000 + i, line(rng, 30) + "\n" + hot) for i in range(80)]
    rows += [(2000, None), (2001, ""), (2002, "\n\n"), (2003, hot + "  "), (2003, hot + "  "), (2004, (line(rng, 3) + "\n") * 60),
             (2005, line(rng, 20_000))]
    df = spark.createDataFrame([(d, t, 3) for d, t in rows], "doc_id long, text string, runs int")
    out = ld.without_runs(df, ld.repeated_runs(df.repartition(4)), "kept", "gone")
    got = [(r["doc_id"], r["kept"], r["gone"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    first = next(r for r in got if r[0] == 1000)
    assert hot in first[1] and all(hot not in r[1] for r in got if r[0] and 1000 < r[0] < 1080)


def test_null_ids_and_columns(spark):
    rng = random.Random(2)
    passage = line(rng, 60)
    rows = [(None, "a\n" + passage, "z"), (7, "b\n" + passage, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __removed string")
    out = ld.drop_repeated_runs(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {None: "a", 7: "b\n" + passage}
    assert ld.drop_repeated_runs(df.limit(0)).count() == 0
