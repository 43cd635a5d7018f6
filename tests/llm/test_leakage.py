import random

from tessella.llm import leakage as lk

WORDS = "anchor archive breath bridge carpenter corner corpus digit editor energy engine filter frame garden harbor interval kitchen ladder lantern laugh ledger lexicon marker market".split()
CHARS = "我你他在山上河边看书听歌写字买菜打开窗门喜欢知道电脑桌椅苹果咖啡今天昨日早晚朋友老师学生医生慢快轻重新旧高低大小"


def english(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def chinese(rng, n):
    return "".join(rng.choice(CHARS) + ("，" if rng.random() < 0.1 else "") for _ in range(n)) + "。"


def changed(rng, text, every, zh):
    units = list(text) if zh else text.split(" ")
    for i in range(rng.randrange(every), len(units), every):
        units[i] = rng.choice(CHARS if zh else WORDS)
    return ("" if zh else " ").join(units)


KIND_D = "doc_id bigint, text string, item_id int, share string"
KIND_I = "item_id bigint, text string, doc_id int"


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], KIND_D)
    i = spark.createDataFrame([(*r, 1) for r in items], KIND_I)
    return {(r.doc_id, r.item_id) for r in lk.leaks(d, i, **kw).collect()}


def test_whole_changed_scattered_and_short(spark):
    rng = random.Random(11)
    en, zh = english(rng, 120), chinese(rng, 160)
    items = [(1, en), (2, zh), (3, english(rng, 100)), (4, chinese(rng, 150))]
    ew, zc = en.split(" "), zh
    docs = [
        (10, english(rng, 50) + "\n" + en + english(rng, 40)), (11, chinese(rng, 80) + zh), (12, changed(rng, en, 8, False)), (13, changed(rng, zh, 9, True)),
        (14, en.upper().replace(" ", "  \n")), (15, "<|zh|>" + " ".join(zh).replace("，", "[Uhm]")), (16, "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in en)),
        (17, " ".join(ew[60:90]) + english(rng, 30) + " " + " ".join(ew[:40])), (18, zc[100:] + chinese(rng, 30) + zc[:50]),
        (20, english(rng, 60) + " ".join(ew[:40]) + english(rng, 60)), (21, chinese(rng, 60) + zc[:55] + chinese(rng, 60)), (22, english(rng, 4000)), (23, chinese(rng, 4000)), (24, None), (25, ""), (None, en),
    ]
    docs.append((10, docs[0][1]))
    assert found(spark, docs, items) == {(10, 1), (11, 2), (12, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1), (18, 2)}


def test_many_random_cases():
    rng = random.Random(5)
    texts = [(english if k % 2 else chinese)(rng, rng.randrange(80, 200)) for k in range(20)]
    scanner = lk.Scanner(list(enumerate(texts)))
    for k, text in enumerate(texts):
        zh = k % 2 == 0
        noise = (chinese if zh else english)(rng, 300)
        assert [i for i, _, _ in scanner.find(noise + changed(rng, text, 10, zh) + noise)] == [k]
        units = text if zh else text.split(" ")
        part = units[: int(len(units) * 0.35)]
        assert scanner.find(noise + ("" if zh else " ").join(part) + noise) == []


def test_offsets_map_back(spark):
    rng = random.Random(2)
    item = chinese(rng, 100)
    before = "Intro [Sigh] １２３ words，"
    d = spark.createDataFrame([(1, before + item + "尾")], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    row = lk.leaks(d, i).first()
    p = row.passages[0]
    assert row.share > 0.95 and len(row.passages) == 1
    assert (before + item)[p.char_from : p.char_to].rstrip("尾。") == item.rstrip("。")


def test_blocks_equal_one_automaton(spark):
    rng = random.Random(3)
    items = [(i, english(rng, 60)) for i in range(6)]
    docs = [(10 + i, english(rng, 20) + t) for i, t in items]
    want = {(10 + i, i) for i, _ in items}
    assert found(spark, docs, items) == found(spark, docs, items, block_tokens=130) == want


def test_any_number_of_different_words(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(1000))) for i in range(200)]
    assert found(spark, [(1, items[150][1]), (2, items[3][1][: len(items[3][1]) // 3])], items) == {(1, 150)}


def test_even_changes_are_bridged():
    rng = random.Random(8)
    zh = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(150)) for _ in range(10)]
    en = [" ".join(f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(80)) for _ in range(10)]
    scanner = lk.Scanner(list(enumerate(zh + en)))
    for k, text in enumerate(zh + en):
        units, every = (list(text), 6) if k < 10 else (text.split(" "), 4)
        units[:: every] = ["字" if k < 10 else "other"] * len(units[::every])
        assert [i for i, _, _ in scanner.find(("" if k < 10 else " ").join(units))] == [k]


def test_tokens_of_a_batch_equal_those_of_each_text():
    texts = ["Ab c<|x|>d", "", "ﬁ x가나", "\0nul\0", "e\u0301t\u200be [Sigh] 中文", "１２ ab_cd"]
    whole = lk.tokens(texts)
    for n, text in enumerate(texts):
        one = lk.tokens([text])
        mine = (whole.doc == n) & (whole.name != lk._END)
        assert whole.name[mine].tolist() == one.name.tolist()
        assert (whole.at[mine] - sum(len(x) + 1 for x in texts[:n])).tolist() == one.at.tolist()


def test_empty_sides_and_odd_items(spark):
    assert found(spark, [(1, "a b c")], []) == set() and found(spark, [], [(1, "a b c")]) == set()
    assert found(spark, [(1, "x y"), (2, "ok then")], [(1, None), (2, "！！"), (None, "x y"), (3, "ok then")]) == {(2, 3)}


def test_long_document(spark):
    rng = random.Random(9)
    item = english(rng, 100)
    assert found(spark, [(1, english(rng, 60_000) + item + english(rng, 60_000)), (2, "字" * 500_000)], [(1, item)]) == {(1, 1)}
