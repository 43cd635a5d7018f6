import random

import numpy as np

from tessella.llm import quality as ql

ZH_N, ZH_V = ["老师", "学生", "咖啡", "电脑", "桌子", "故事", "文件", "声音", "图片"], ["买", "看", "打开", "修改", "播放", "喜欢", "保存"]
EN_N, EN_V = ["anchor", "bridge", "corner", "engine", "garden", "harbor", "ladder", "market"], ["opens", "moves", "keeps", "reads", "drops"]


def prose(rng, zh, lines=None):
    one = (lambda: f"今天{rng.choice(ZH_N)}在家里{rng.choice(ZH_V)}了{rng.choice(ZH_N)}，因为他很喜欢那个{rng.choice(ZH_N)}。") if zh else (lambda: f"The {rng.choice(EN_N)} of the {rng.choice(EN_N)} {rng.choice(EN_V)} what every {rng.choice(EN_N)} {rng.choice(EN_V)} after a while.")
    s = [one() for _ in range(rng.randrange(3, 30))]
    return ("\n" if rng.random() < 0.3 else " " * (not zh)).join(s)


def other(rng):
    n = rng.randrange(8, 40)
    kind = rng.randrange(6)
    if kind == 0:
        return "list", "\n".join(f"- {' '.join(rng.choices(ZH_N + ZH_V, k=rng.randrange(1, 4)))}" for _ in range(n))
    if kind == 1:
        return "list", "; ".join(rng.choices(EN_N, k=3 * n))
    if kind == 2:
        return "tabular", "a,b,c\n" + "\n".join(f"{rng.random():.3f},{rng.randrange(400)},ok" for _ in range(n))
    if kind == 3:
        return "tabular", "\n".join(f"[{rng.randrange(24):02}:{rng.randrange(60):02}] INFO {rng.choice(EN_N)}={rng.random():.3f} done" for _ in range(n))
    if kind == 4:
        return "junk", "".join(rng.choice("#$%^&*<>{}~=+\n") for _ in range(30 * n))
    return "junk", "\n".join("".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(64)) for _ in range(n // 3))


def corpus(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind, text = ("prose", prose(rng, rng.random() < 0.5)) if rng.random() < 0.8 else other(rng)
        out.append((i, kind, text))
    return out


DOCS = "doc_id bigint, text string, words string, kind string"
LABELS = "doc_id bigint, rater string, kind string"


def kinds(spark, docs, labels):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS)
    return {r.doc_id: r for r in ql.document_kinds(d, spark.createDataFrame(labels, LABELS)).collect()}


def test_statistics():
    x = dict(zip(ql.STATS, ql.text_stats(["The cat sat on a mat.\nIt is 12!\n\n", "", "今天我在家，看书。"]).T, strict=True))
    assert x["words"].tolist() == [9, 0, 7] and x["line_ends"].tolist() == [1, 0, 1]
    assert x["common"][0] == 5 / 9 and abs(x["digits"][0] - 2 / 23) < 1e-9 and abs(x["symbols"][0] - 2 / 23) < 1e-9
    assert x["mean_word"][2] == 1.0 and x["sentences"].tolist() == [1, 0, 1]


def test_statistics_do_not_depend_on_the_batch():
    texts = [t for _, _, t in corpus(1, 40)] + ["", "\n\n", "a\r\nb", "😀" * 5, "�" * 9, "ｆｕｌｌ ｏｆ ｔｈｅ​ ｗｉｄｅ"]
    whole = ql.text_stats(texts)
    assert np.allclose(whole, np.vstack([ql.text_stats([t]) for t in texts]))


def test_common_words_against_a_plain_count():
    text = prose(random.Random(4), False)
    words = [w.strip(".").lower() for w in text.split()]
    want = sum(w in ql.COMMON_WORDS for w in words) / len(words)
    assert abs(ql.text_stats([text])[0][ql.STATS.index("common")] - want) < 1e-9


def test_held_out_accuracy(spark):
    docs = corpus(2, 900)
    rng = random.Random(6)
    labels = [(i, "r1", k if rng.random() > 0.05 else rng.choice(ql.KINDS)) for i, k, _ in docs[:150]]
    got = kinds(spark, [(i, t) for i, _, t in docs], labels)
    hits = sum((got[i].kind == "prose") == (k == "prose") for i, k, _ in docs[150:])
    assert hits / 750 > 0.97


def test_without_labels(spark):
    docs = corpus(3, 500)
    got = kinds(spark, [(i, t) for i, _, t in docs], [])
    assert sum((got[i].kind == "prose") == (k == "prose") for i, k, _ in docs) / 500 > 0.95


def test_edges(spark):
    assert kinds(spark, [], []) == {}
    got = kinds(spark, [(1, None), (2, ""), (3, "字" * 1_500_000), (None, "x"), (4, "The end of it."), (4, "The end of it.")], [(9, "r", "prose"), (4, "r", None), (4, "r", "odd")])
    assert set(got) == {2, 3, 4}


def test_likelihood_rises(spark):
    docs = corpus(4, 400)
    stats = spark.createDataFrame([(i, *map(float, x)) for (i, _, _), x in zip(docs, ql.text_stats([t for _, _, t in docs]), strict=True)], ql._STATS_SCHEMA).cache()
    x = np.array([[r[s] for s in ql.STATS] for r in stats.collect()])
    empty = spark.createDataFrame([], LABELS)

    def loglik(m):
        z = m.standardized(x)
        out = np.zeros((len(z), len(m.weight)))
        for k in range(len(m.weight)):
            d = z - m.mean[k]
            out[:, k] = np.log(m.weight[k]) - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(m.cov[k]), d) - 0.5 * np.linalg.slogdet(m.cov[k])[1]
        return np.logaddexp.reduce(out, axis=1).mean()

    values = [loglik(ql.fit_mixture(stats, empty, rounds=r, tolerance=0)) for r in (1, 3, 6)]
    assert values[0] < values[1] < values[2] + 0.05
