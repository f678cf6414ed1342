"""Quality rules against brute force."""

import random
import re

from encore.llm import quality
from util import ODD, docs, rows, table


def brute(text, window=8):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(window)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def test_measures_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["\n".join(rng.choice(["x y", " ", "", "z|"]) for _ in range(9)) for _ in range(20)]
    texts += [r["text"] for r in table("documents")]
    found = {r[0]: r for r in rows(quality.report(docs(spark, list(enumerate(texts)), extra=True)))}
    for i, text in enumerate(texts):
        assert found[i][1:7] == brute(text), text[:80]
        assert not (found[i][6] and found[i][7])


def test_odd_rows(spark):
    found = rows(quality.report(docs(spark, ODD, extra=True)))
    assert len(found) == len(ODD)
    wanted = sorted(((i, *brute(t)) for i, t in ODD), key=repr)
    assert sorted((r[:7] for r in found), key=repr) == wanted
    assert quality.report(docs(spark, [])).count() == 0
    assert quality.keep(docs(spark, [])).count() == 0


def test_verdict_does_not_depend_on_the_order(spark):
    frame = docs(spark, [(r["doc_id"], r["text"]) for r in table("documents")])
    rules = quality.rules()
    verdicts = [
        rows(frame.select("doc_id", quality.rejected_by_any(order).alias("out"))) for order in (rules, rules[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    kept = {r["doc_id"] for r in quality.keep(frame).collect()}
    assert kept == {i for i, out in verdicts[0] if not out}
    assert kept == {r["doc_id"] for r in quality.report(frame).filter("kept").collect()}


def test_cascade_orders_by_rejection_per_cost(spark):
    frame = docs(spark, [(r["doc_id"], r["text"]) for r in table("documents")])
    plan = quality.plan_cascade(frame, quality.rules())
    gains = [share / seconds for _, share, seconds in plan]
    assert gains == sorted(gains, reverse=True) and len(plan) == len(quality.rules())


def test_clean_text_is_kept_and_junk_is_not(spark):
    clean = "The quick brown fox jumps over a lazy dog while many other animals look on from the edge of the wood, and nobody minds."
    junk = {
        2: clean.upper() + "!!",
        3: " ".join(w + "***" for w in clean.split()),
        4: "buy now " * 40,
        5: "too short",
        6: " | ".join(clean.split()),
        7: "\n".join([clean[:40]] * 6 + [clean]),
        8: " ".join(str(i * 7919) for i in range(60)),
    }
    found = {r["doc_id"]: r["kept"] for r in quality.report(docs(spark, [(1, clean), *junk.items()])).collect()}
    assert found == {1: True} | dict.fromkeys(junk, False)


def test_clean_text_of_any_script_is_kept(spark):
    clean = {
        "hi": "यह एक साधारण वाक्य है जिसमें हिन्दी के बहुत से शब्द हैं और हम इसे पढ़ते हुए कुछ नया सीखते हैं ताकि आगे चलकर काम आए",
        "ta": "இது ஒரு எளிய தமிழ் வாக்கியம் ஆகும் இதில் பல சொற்கள் உள்ளன நாங்கள் இதைப் படித்து புதிய செய்திகளைக் கற்றுக் கொள்கிறோம் பின்னர் அது நமக்கு உதவும் என்று நம்புகிறோம் மேலும் பலர் இதை விரும்பிப் படிக்கிறார்கள்",
        "my": "မြန်မာ ဘာသာ စကား ကို ကျွန်တော် တို့ နေ့စဉ် သုံး ပါ သည် ဤ စာကြောင်း သည် ရိုးရှင်း သော ဝါကျ ဖြစ် သည် ကျေးဇူး တင် ပါ သည် မိတ်ဆွေ",
        "zh": " ".join(f"这是第{c}个句子里面写的是普通的中文内容没有任何空格分开词语。" for c in "一二三四五六七八九十百千万东西南北春夏秋冬"),
        "ja": " ".join(f"これは{c}についての普通の日本語の文章で単語の間に空白はありません。" for c in "一二三四五六七八九十百千万東西南北春夏秋冬"),
        "th": " ".join(f"นี่คือประโยคภาษาไทยธรรมดาที่ไม่มีการเว้นวรรคระหว่างคำ{c}" for c in "กขคงจฉชซญดตถทธนบปผพฟมย"),
    }
    words = clean["zh"].split()[0]
    junk = {
        "long": " ".join("x" * 30 + str(i) for i in range(30)),
        "some": " ".join(f"{words[:4]}{'abcdefghij' * 3}{i}" for i in range(30)),
        "marks": " ".join(f"{i * 7919}" for i in range(60)),
    }
    names = [*clean, *junk]
    given = docs(spark, [(i, (clean | junk)[n]) for i, n in enumerate(names)])
    found = {names[r["doc_id"]]: r["kept"] for r in quality.report(given).collect()}
    assert found == dict.fromkeys(clean, True) | dict.fromkeys(junk, False)
    assert {names[r["doc_id"]] for r in quality.keep(given).collect()} == set(clean)


def test_no_python_in_the_plan(spark):
    plan = quality.report(docs(spark, [(1, "a b")])) ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
