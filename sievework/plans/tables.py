"""Stand-ins: the driver's tables read as postings, runs and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A row's place in its table: what ``placed`` adds.
PLACE = ("_file", "_row")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with each row's file and place in the file, which order rows as they were written, however Spark reads them."""
    return table(spark, sf_dir, name).select("*", *[F.col(f"_metadata.{m}").alias(c) for m, c in zip(("file_path", "row_index"), PLACE)])


def _pick(words: str, by: str, n: int) -> str:
    return f"split_part('{words}', '|', cast({by} % {n} as int) + 1)"


_PAY = "cast(floor(o_totalprice / 10000) as int) + 5"

#: Posting columns made of an order and its customer's key, in SQL that Spark and DuckDB share. Values are invented.
POSTING_COLUMNS = {
    "job": "o_orderkey",
    "customer": "o_custkey",
    "job_link": "concat('https://jobs.example/', o_orderkey)",
    "title": _pick("AI产品经理|产品经理实习生|大客户销售|算法工程师|新媒体运营|AIGC内容运营|数据标注|产品运营|行政前台|电商直播运营|AI解决方案工程师|FDE部署", "o_orderkey", 12),
    "company_name": _pick("某互联网公司|星海科技|知名电商|云图工作室|北京智行机器人|量子数据|上海远山AI实验室|蓝湖贸易", "o_custkey", 8),
    "company_industry": _pick("互联网|人工智能|电子商务|餐饮|", "o_custkey", 5),
    "boss_title": _pick("招聘者|猎头顾问|HRBP|产品总监|招聘主管|创始人|", "o_orderkey", 7),
    "proxy_job": "case when o_orderkey % 13 = 0 then '1' else '' end",
    "job_type": "case o_orderkey % 9 when 0 then '4' when 1 then '5' else '' end",
    "location": _pick("杭州·余杭区·仓前|杭州|北京·海淀区|上海·浦东新区|杭州·西湖区|深圳", "o_custkey", 6),
    "experience": _pick("应届生|1年以内|1-3年|3-5年|5-10年|10年以上|经验不限|", "o_orderkey", 8),
    "salary": f"case o_orderkey % 6 when 0 then concat({_PAY}, '-', {_PAY} + 10, 'K') when 1 then concat({_PAY}, '-', {_PAY} + 12, 'K·15薪') when 2 then concat(({_PAY}) * 10, '-', ({_PAY}) * 10 + 50, '元/天') when 3 then '面议' when 4 then concat(({_PAY}) * 1000, '-', ({_PAY}) * 1000 + 3000, '元/月') else '' end",
    "jd": _pick("负责AI产品规划 对接大模型团队|完成业绩指标 享受提成|负责产品需求与运营数据|对AI感兴趣者优先 负责社区内容|招募合伙人 股权合作|用户运营 提成 智能体应用|门店客服排班|行政与前台接待|兼职 日结|熟悉SQL 负责数据产品|", "o_orderkey", 11),
    "skill_text": _pick("Python,SQL|大模型,Axure|沟通|", "o_custkey", 4),
    "activity": _pick("刚刚活跃|在线|2周前活跃|3月前活跃|本周活跃|半年前活跃|", "o_orderkey", 7),
    "updated": "cast(cast(o_orderdate as date) as {text})",
    "education": _pick("本科|硕士|大专|学历不限|博士|", "o_custkey", 6),
    "company_scale": _pick("0-20人|20-99人|100-499人|", "o_custkey", 4),
    "company_stage": _pick("天使轮|A轮|已上市|", "o_orderkey", 4),
    "tags": f"concat({_pick('应届生|1-3年|经验不限|沟通', 'o_orderkey', 4)}, ' | ', {_pick('本科|大专|学历不限|', 'o_custkey', 4)}, ' | ', {_pick('大模型|SQL|', 'o_orderkey', 3)})",
    "job_labels": f"concat({_pick('五险一金|3-5年|', 'o_custkey', 3)}, '｜', {_pick('双休||Python', 'o_orderkey', 3)})",
    "welfare": f"replace({_pick('五险一金、年终奖|年终奖、补充医疗保险|五险一金|', 'o_orderkey', 4)}, '、', ' | ')",
    "icon_word": _pick("急聘||校友|", "o_orderkey", 4),
    "icon_flags": f"replace({_pick('新|热、新|', 'o_custkey', 3)}, '、', '|')",
    "boss_name": _pick("王女士|李先生|", "o_custkey", 3),
    "keyword": _pick("AI产品经理|数据产品|运营|", "o_orderkey", 4),
}


def posting_sql() -> str:
    """The postings as a DuckDB query."""
    return "select " + ", ".join(f"{e} as {n}" for n, e in POSTING_COLUMNS.items()).replace("{text}", "varchar") + " from orders"


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{e.replace('{text}', 'string')} as {n}" for n, e in POSTING_COLUMNS.items()])
    return rows.withColumn("skills", F.filter(F.split("skill_text", ","), lambda s: s != ""))
