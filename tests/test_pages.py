from pyspark.sql import functions as F

from sievework.functions import pages

BODY = "负责产品规划与需求分析，推动项目落地。" * 4


def test_page_bodies(spark):
    rows = [
        (f"职位描述：\n{BODY}\n举报 · 分享\n\n张女士\n今日活跃\n星海科技·招聘经理", "页面更新时间：2024-05-01", ["SQL"], None),
        (None, f"首页\n职位描述\nSQL\n{BODY}\n李先生\n\n安全提示\n别的", ["SQL"], "在线"),
        ("登录查看完整内容", "", [], None),
        ("太短", None, None, None),
        (None, "无障碍专区 首页 职位 公司", None, None),
        (f"{BODY}\n\n王先生", "3日内活跃", None, ""),
    ]
    got = spark.createDataFrame(rows, "jd string, page string, tags array<string>, shown string").select(pages.extract_body("jd", "page", "tags", "shown").alias("x")).select("x.*").collect()
    assert [r.error for r in got] == ["", "", "login", "short", "navigation", ""]
    assert got[0].jd == BODY and got[0].boss_active_status == "今日活跃" and got[0].page_update_date == "2024-05-01"
    assert got[1].jd.startswith(BODY) and got[1].boss_active_status == "在线"
    assert got[5].jd == BODY and got[5].boss_active_status == "3日内活跃"


def test_cards_at_the_end_of_a_text(spark):
    """Each form of card, also before a marker and with empty lines, and texts that only look like one."""
    text = BODY.split("，")
    cards = [
        (["张三", "今日活跃", "星海科技", "·", "招聘经理"], "今日活跃"), (["张三", "星海科技", "·", "招聘经理"], ""), (["张女士", "在线", "星海科技"], "在线"), (["张女士", "", "离职中", "星海科技·人事", ""], "离职中"),
        (["李先生（已认证）", "星海科技·招聘"], ""), (["", "王先生"], ""), (["王先生"], None), (["张女士", "负责一切。", "在线"], None), (["在线", "星海科技"], None), ([], None),
    ]
    df = spark.createDataFrame([(i, [*text, *lines]) for i, (lines, _) in enumerate(cards)], "i int, lines array<string>").select("i", pages.card(F.col("lines")).alias("c"))
    for r in df.collect():
        lines, status = cards[r.i]
        kept = len(text) + (len(lines) if status is None else lines[0] == "")
        assert (r.c.start, r.c.status) == (kept, status or ""), lines
    page = "\n".join([*text, "张三", "本周活跃", "星海科技", "·", "招聘经理", "竞争力分析", "其他"])
    got = body(spark, page, "", None, None)
    assert (got.error, got.boss_active_status, got.jd) == ("", "本周活跃", "\n".join(text))


def body(spark, *row):
    df = spark.createDataFrame([row], "jd string, page string, tags array<string>, shown string")
    return df.select(pages.extract_body("jd", "page", "tags", "shown").alias("x")).select("x.*").first()


def test_marks_tags_and_noise(spark):
    """What stands before a mark stays in a body and goes from a page; a mark at a body's head goes with its separators; tags go at the head alone."""
    assert body(spark, f"【公司介绍】\n{BODY}\n【职位描述】\n更多", "", None, None).jd == f"【公司介绍】\n{BODY}\n【职位描述】\n更多"
    assert body(spark, f"微信扫码分享 举报\n\n职位描述】：\r\n{BODY}", "", None, None).jd == BODY
    assert body(spark, f"职位描述：{BODY}", "", None, None).jd == BODY
    assert body(spark, "", f"AI产品经理\n200-300元/天\n职位描述\n{BODY}", None, None).jd == BODY
    tagged = body(spark, f"B端产品\nSQL Python\n\n{BODY}\nSQL\n{BODY}\n夏女士\n星海科技·HR", "", ["SQL", "B端产品", None, "Python"], None)
    assert tagged.jd == f"{BODY}\nSQL\n{BODY}"
    assert body(spark, f"SQL\n{BODY}", "", ["", None], None).jd == f"SQL\n{BODY}"
    assert body(spark, f"{BODY}\n\n\n\n a  b \n这不是安全提示，只是说说安全提示", "", None, None).jd == f"{BODY}\n\na b\n这不是安全提示，只是说说安全提示"
    assert body(spark, None, None, None, None).error == "short"


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a", "b", ["c"], "d")], "jd string, page string, tags array<string>, shown string").select(pages.extract_body("jd", "page", "tags", "shown"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
