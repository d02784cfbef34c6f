"""Line rules over languages and scripts."""

from __future__ import annotations

from vigil.llm import lines

GOOD = "This is a sentence that stays, since it says something about the weather."


def test_lines_of_all_languages(spark):
    bad = ["Read more", "Weiterlesen", "Alle Rechte vorbehalten 2024", "Tous droits réservés, Exemple SA", "CLIQUEZ ICI pour la suite de cet article",
           "Lea nuestra política de privacidad", "Home | News | Sport", "Menü", "首页 关于", "a # b & c"]
    good = [GOOD, "今天的天气很好我们一起去公园散步然后回家吃饭真是开心的一天啊哈哈", "Er liest weiter in dem Buch, das ihm gefällt.", "Ja, so ist es.", "他说。"]
    more = " ".join(f"word{i}" for i in range(39)) + "."
    text = "\n".join(x for a, b, c in zip(bad[::2], bad[1::2], good) for x in (a, b, c))
    df = spark.createDataFrame([(1, text + "\n" + more), (2, "\n".join(bad * 3)), (3, None), (4, "")], "doc_id long, text string")
    clean = {r.doc_id: r.text.split("\n") for r in lines.clean_lines(df, max_lost=0.9).collect()}
    assert not set(bad) & set(clean[1]) and set(good) <= set(clean[1])
    judged = {r.doc_id: r for r in lines.judge_lines(df).collect()}
    assert judged[1].n_lines_removed == len(bad) and not judged[2].kept and not judged[3].kept and judged[4].n_words == 0
    assert lines.judge_lines(df.limit(0)).collect() == []
