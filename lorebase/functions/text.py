"""Column functions over names, prescriptions and notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Names of forms, doses, stop words and labels of the curated data.
PREPARATION = "生|熟|炙|炒|酒|醋|盐|姜|蜜|土|麸|煅|煨|炮|制"
DOSE = r"[一二三四五六七八九十百千万\d]+[钱两克斤升斗个枚条]"
FORMULA_ENDINGS = ("汤", "丸", "散", "饮", "膏", "丹")
NOT_HERB_LINES = ("付", "碗", "煮", "服", "次", "日", "帖", "包", "颗", "丸")
CATEGORIES = (
    ("补益", ("补", "益", "养", "滋", "填", "固", "敛", "收")),
    ("清热", ("清", "凉", "泻", "降火", "退热", "解毒")),
    ("祛寒", ("温", "散寒", "回阳", "暖", "祛寒")),
    ("理气", ("理气", "行气", "疏肝", "解郁", "宽胸", "降气")),
    ("活血", ("活血", "化瘀", "通络", "散结", "消癥")),
    ("祛湿", ("祛湿", "利湿", "化湿", "燥湿", "渗湿", "利水")),
    ("化痰", ("化痰", "祛痰", "涤痰", "消痰")),
    ("解表", ("解表", "发汗", "散风", "祛风")),
    ("攻下", ("攻下", "通便", "泻下", "润肠")),
    ("固涩", ("固涩", "止泻", "止汗", "止带", "止遗")),
    ("安神", ("安神", "镇静", "宁心", "定志")),
    ("开窍", ("开窍", "醒神", "通关")),
    ("消食", ("消食", "化积", "导滞")),
    ("驱虫", ("驱虫", "杀虫")),
    ("外治", ("外治", "敷", "洗", "熏", "灸", "针")),
)
METHOD_SIGNS = ("法", "方", "汤", "散", "丸")


def ustrip(c: Column) -> Column:
    """Strip white space of any script, the ideographic space too."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column, strip: bool = True) -> Column:
    """Null where a value is missing, which an empty string also says."""
    return F.nullif(ustrip(c) if strip else c, F.lit(""))


def like_any(columns: list[str], keyword: str, escape: bool = False) -> Column:
    """Any of the columns holds the keyword, in either case; % and _ in it are wild unless escaped."""
    pattern = keyword.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") if escape else keyword
    return reduce(Column.__or__, [F.coalesce(F.col(c).ilike(f"%{pattern}%"), F.lit(False)) for c in columns])


def preview(c: Column, n: int = 200) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


def herb_name(c: Column) -> Column:
    """A herb's plain name: without preparation sign, dose and brackets, in that order."""
    out = F.regexp_replace(ustrip(c), f"^({PREPARATION})", "")
    out = F.regexp_replace(out, r"(?U)(?d)\d+.*$", "")
    return ustrip(F.regexp_replace(out, "[（(].*?[）)]", ""))


def composition_herbs(c: Column, separators: str = ",") -> Column:
    """Herb names of a composition list, repeated ones kept."""
    parts = F.split(F.coalesce(c, F.lit("")), f"[{separators}]")
    names = F.transform(parts, lambda p: ustrip(F.regexp_replace(ustrip(p), "(?U)" + DOSE, "")))
    return F.filter(names, lambda n: n != "")


def formulas_in(c: Column) -> Column:
    """Distinct formula names: two to six characters and an ending."""
    found = [F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"([一-龥]{{2,6}}{e})"), F.lit(1)) for e in FORMULA_ENDINGS]
    return F.array_distinct(F.flatten(F.array(*found)))


def herbs_in(c: Column) -> Column:
    """Distinct herb names of a prescription text; lines on taking it are passed over."""
    lines = F.filter(
        F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), ustrip),
        lambda s: reduce(Column.__and__, [~s.contains(w) for w in NOT_HERB_LINES]) & (s != ""),
    )
    parts = F.flatten(F.transform(lines, lambda s: F.split(s, "(?U)" + DOSE)))
    names = F.transform(parts, lambda p: ustrip(F.regexp_replace(ustrip(p), "[（(].*?[）)]", "")))
    return F.array_distinct(F.filter(names, lambda n: n.rlike("^[一-龥]{2,4}$")))


def list_of(c: Column) -> Column:
    """A JSON array or a comma list; what is neither is one value."""
    text = ustrip(c)
    parsed = F.from_json(text, "array<string>")
    plain = F.filter(F.transform(F.split(text, ","), ustrip), lambda s: s != "")
    return F.when(text.startswith("["), F.coalesce(parsed, F.array(text))).otherwise(plain)


def without_markup(c: Column) -> Column:
    return ustrip(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\*\*", ""))


def person_name(c: Column) -> Column:
    return ustrip(F.regexp_replace(F.regexp_replace(F.lower(c), "[,.\\-']", " "), r"(?U)\s+", " "))


def patient_name(c: Column) -> Column:
    """A patient id without the eight-digit date at its end."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(?U)^(.+?)\s+\d{8}$", 1), F.lit("")), c)


def patient_id(name: Column, stem: Column, case_date: Column) -> Column:
    day = F.nullif(F.replace(case_date, F.lit("-"), F.lit("")), F.lit(""))
    return F.concat_ws(" ", F.coalesce(blank_to_null(name), stem), day)


def treatment_category(name: Column, description: Column) -> Column:
    """The first category any of whose words occurs."""
    text = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(description, F.lit(""))))
    out = F.when(reduce(Column.__or__, [text.contains(w) for w in METHOD_SIGNS]), "方剂治法").otherwise("其他")
    for category, signs in reversed(CATEGORIES):
        out = F.when(reduce(Column.__or__, [text.contains(w) for w in signs]), category).otherwise(out)
    return out


def hours_of(lessons: Column) -> Column:
    """An hour and a half a lesson; null for none."""
    return F.when(lessons > 0, F.round(lessons * F.lit(1.5), 1).cast("double"))


def case_date(c: Column) -> Column:
    return F.nullif(F.translate(F.regexp_extract(c, r"(\d{4}[/-]\d{1,2}[/-]\d{1,2})", 1), "/", "-"), F.lit(""))


def gender(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(男|女)", 1), F.lit(""))


def age(c: Column) -> Column:
    years = F.nullif(F.regexp_extract(c, r"(?U)(\d+)\s*岁", 1), F.lit(""))
    return F.concat(years, F.lit("岁"))


def word_count(c: Column) -> Column:
    """Characters, which is how lengths are kept."""
    return F.coalesce(F.length(c), F.lit(0))


def stem_tags(stem: Column) -> Column:
    return F.to_json(F.array(stem))


def markdown_html(c: Column) -> Column:
    """Screenshots, images, bold, headings, quotes and line ends as HTML, rewritten in this order."""
    frame = "max-width:100%;border-radius:6px;margin:8px 0;"
    shadow = frame + "box-shadow:0 2px 8px rgba(0,0,0,0.1);"
    steps = (
        (r"(?U)(?:截图路径[：:]\s*)?assets/screenshots/(\S+\.webp)", f'<img src="/screenshots/$1" alt="截图" style="{shadow}" loading="lazy">'),
        (r"!\[([^\]]*)\]\([^)]*screenshots/([^)]+)\)", f'<img src="/screenshots/$2" alt="$1" style="{frame}" loading="lazy">'),
        (r"!\[([^\]]*)\]\(([^)]+)\)", '<img src="$2" alt="$1" style="max-width:100%;">'),
        (r"(?d)\*\*(.+?)\*\*", "<strong>$1</strong>"),
        (r"(?md)^### (.+)$", '<h4 style="margin:12px 0 6px;color:#8b7355;">$1</h4>'),
        (r"(?md)^## (.+)$", '<h3 style="margin:16px 0 8px;color:#5b4a3f;">$1</h3>'),
        (r"(?md)^# (.+)$", '<h2 style="margin:20px 0 10px;">$1</h2>'),
        (r"(?md)^> (.+)$", '<blockquote style="border-left:3px solid #c9b99a;padding-left:12px;color:#666;margin:8px 0;">$1</blockquote>'),
        ("\n", "<br>"),
    )
    return reduce(lambda out, s: F.regexp_replace(out, s[0], s[1]), steps, F.coalesce(c, F.lit("")))
