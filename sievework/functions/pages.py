"""Bodies out of page text, in Columns: lines become letters of their kinds, and what frames a body is found by patterns over these letters.

A position in the letters is a position in the lines, so a match says which lines go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import as_col, let

# Marks of the pages' own text, and words of recruiter cards.
LOGIN_WALL, BODY_MARK = "登录查看完整内容", "职位描述"
END_MARKS = ("竞争力分析", "安全提示")
NOISE = ("举报", "微信扫码分享", "去APP", "去", "APP", "小程序", "分享", "收藏", "立即沟通", "投诉", "下载APP", "下载")
NAVIGATION = ("无障碍专区", "首页", "职位", "公司")
PRESENCE = ("已离职", "离职中", "在职", "可联系", "暂不可联系", "在线")
NAME = "^[一-鿿]{1,3}(?:先生|女士)(?:[（(][^）)]{0,6}[）)])?$"
POSITION = "^[^·\\n]{2,30}·[^·\\n]{1,12}$"
ACTIVE = f"^(?:{'|'.join(PRESENCE)}|.*活跃)$"
ACTIVITY = "刚刚活跃|今日活跃|\\d+日内活跃|本周活跃|\\d+周内活跃|\\d+个?月内活跃|半年前活跃"
UPDATED = "页面更新时间[：:]\\s*(\\d{4}-\\d{2}-\\d{2})"

#: Characters that a body has at the least, and that a line with an end mark has at the most.
LEAST_BODY, END_LINE = 50, 12

#: Kinds of lines, a letter each, the first that fits: nothing, a lone dot, a person, a presence, a position, a short line without punctuation; x is any other.
KINDS = (("_", "^$"), (".", "^·$"), ("N", NAME), ("A", ACTIVE), ("P", POSITION), ("C", "^[^。！？；，、:：!?,;]{2,30}$"))
#: Recruiters' cards at a text's end, as kinds of lines, and where a presence stands in one: person, presence or not, company, dot and position on lines of their own; person, presence, company; person and position; a person after an empty line.
CARDS = (("[^_]A?[^_]\\.[^_]_*$", "^[^_]A[^_]\\."), ("N_*A_*[NPC]_*$", "^N_*A"), ("N_*P_*$", None), ("(?<=_)N_*$", None))


def _strip(line: Column) -> Column:
    return F.regexp_replace(line, "^[\\s\\p{Z}]+|[\\s\\p{Z}]+$", "")


def _letters(lines: Column, letter) -> Column:
    return F.array_join(F.transform(lines, letter), "")


def _from(lines: Column, start: Column) -> Column:
    return F.slice(lines, start, F.greatest(F.lit(0), F.size(lines) - start + 1))


def _kind(line: Column) -> Column:
    return reduce(lambda w, k: w.when(line.rlike(k[1]), F.lit(k[0])), KINDS, F).otherwise("x")


def _is_noise(line: Column) -> Column:
    parts = F.filter(F.split(line, "[\\s·|/]+"), lambda p: p != "")
    return (F.size(parts) > 0) & F.forall(parts, lambda p: p.isin(*NOISE))


def _after_mark(lines: Column, whole_page: Column) -> Column:
    """A body of its own that begins with the mark loses it; a body that names it later keeps it."""
    first = F.length(F.regexp_extract(_letters(lines, lambda x: F.when(x == "", "_").otherwise("x")), "^_*", 0)) + 1

    def cut(at: Column) -> Column:
        rest = F.regexp_extract(F.get(lines, at - 1), f"{BODY_MARK}[：:】\\]\\s]*(.*)$", 1)
        marked = ~whole_page & F.coalesce(F.get(lines, at - 1).contains(BODY_MARK), F.lit(False))
        return F.when(marked, F.concat(F.array(rest), _from(lines, at + 1))).otherwise(_from(lines, at))

    return let(first, cut)


def _framed(lines: Column, tags: Column) -> Column:
    """The lines behind the leading ones that hold nothing but known tags, and before one that ends the body."""
    of_tags = lambda x: F.forall(F.filter(F.split(x, "[\\s\\p{Z}]+"), lambda w: w != ""), lambda w: F.array_contains(tags, w))
    known = F.exists(tags, lambda t: t != "")
    head = F.when(known, F.length(F.regexp_extract(_letters(lines, lambda x: F.when(of_tags(x), "T").otherwise("x")), "^T*", 0))).otherwise(0)

    def cut(rest: Column) -> Column:
        end = F.locate("E", _letters(rest, lambda x: F.when(x.rlike(f"(?:{'|'.join(END_MARKS)})$") & (F.length(x) <= END_LINE), "E").otherwise("x")))
        return F.when(end > 0, F.slice(rest, 1, end - 1)).otherwise(rest)

    return let(let(head, lambda n: _from(lines, n + 1)), cut)


def card(lines: Column) -> Column:
    """struct(start, status): lines before a recruiter's card at the end, all if there is none, and the card's presence."""

    def found(letters: Column) -> Column:
        begin = lambda match: F.length(letters) - F.length(match)
        out = F
        for pattern, presence in CARDS:
            match = F.regexp_substr(letters, F.lit(pattern))
            # the presence is the last letter but one of its pattern with a dot, else the last
            at = F.lit(None) if presence is None else F.length(F.nullif(F.regexp_extract(match, presence, 0), F.lit(""))) - (2 if presence.endswith(".") else 0)
            status = F.lit("") if presence is None else F.coalesce(F.get(lines, begin(match) + at - 1), F.lit(""))
            out = out.when(match.isNotNull(), F.struct(begin(match).alias("start"), status.alias("status")))
        return out.otherwise(F.struct(F.length(letters).alias("start"), F.lit("").alias("status")))

    return let(_letters(lines, _kind), found)


def extract_body(jd: Column | str, page: Column | str, tags: Column | str, shown: Column | str, least: int = LEAST_BODY) -> Column:
    """struct(jd, boss_active_status, page_update_date, error) of a page: its body without chrome, leading tags and the recruiter's card.

    error is empty, or login, navigation or short, and then the rest is empty. Nulls count as empty.
    """
    some = lambda c: F.coalesce(as_col(c), F.lit(""))
    jd, page, shown, tags = some(jd), some(page), _strip(some(shown)), F.coalesce(as_col(tags), F.array().cast("array<string>"))
    tags = F.filter(tags, lambda t: t.isNotNull())
    everything = F.concat(jd, F.lit("\n"), page)
    chrome = reduce(lambda a, w: a & everything.contains(w), NAVIGATION, ~everything.contains(BODY_MARK))
    marked = F.when(page.contains(BODY_MARK), F.substr(page, F.locate(BODY_MARK, page) + len(BODY_MARK))).otherwise("")
    text = F.when(jd != "", jd).otherwise(marked)
    lines = F.filter(F.transform(F.split(text, "\\r?\\n"), _strip), lambda x: ~_is_noise(x))

    def answer(body: Column, status: Column) -> Column:
        activity = F.regexp_extract(page, ACTIVITY, 0)
        who = F.when(status != "", status).when(shown.rlike(ACTIVE), shown).otherwise(activity)
        error = F.when(everything.contains(LOGIN_WALL), "login").when(chrome, "navigation").when(F.length(body) < least, "short").otherwise("")
        good = lambda c: F.when(error == "", c).otherwise("")
        return F.struct(good(body).alias("jd"), good(who).alias("boss_active_status"), good(F.regexp_extract(page, UPDATED, 1)).alias("page_update_date"), error.alias("error"))

    def without_card(own: Column) -> Column:
        tidy = lambda b: F.regexp_replace(F.regexp_replace(_strip(b), "\\n{3,}", "\n\n"), "[ \\t]{2,}", " ")
        return let(card(own), lambda c: let(tidy(F.array_join(F.slice(own, 1, c.start), "\n")), lambda body: answer(body, c.status)))

    return let(let(let(lines, lambda x: _after_mark(x, jd == "")), lambda x: _framed(x, tags)), without_card)
