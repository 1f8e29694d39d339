"""Text expressions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, spelled out since engines disagree about the short form.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
FOOTER = r"—\p{Nd}+—"
#: Special blanks that proofing turns into spaces or drops (tabs stay).
BLANKS = r"[\x{a0}\x{2000}-\x{200b}\x{202f}\x{205f}\x{3000}]"
HAN, ALNUM = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}", "A-Za-z0-9"
FULL_MARKS = "，。；：？！、（）《》"
#: Half-width marks and the full-width ones that replace them between Han characters.
HALF_TO_FULL = ((",", "，"), (";", "；"), (":", "："), ("?", "？"), ("!", "！"))
#: What a text must have for its marks to be changed.
MARKED = rf"[{FULL_MARKS}]|[,;:?!](?<=[{HAN}].)(?=[{HAN}])"


def remove_space(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, WS + "+", "")


def is_blank(text: Column) -> Column:
    """Whether a text has nothing but white space; null counts as blank."""
    return ~F.coalesce(F.regexp_like(text, F.lit(f"[^{WS[1:]}")), F.lit(False))


def remove_footers(text: Column) -> Column:
    """Without page numbers between dashes; for text without white space."""
    return F.regexp_replace(text, FOOTER, "")


def remove_prefix(text: Column, names: Sequence[str]) -> Column:
    """Without one of the names in front, at most."""
    return F.regexp_replace(text, "^(?:" + "|".join(names) + ")", "")


def is_blank_page(text: Column, names: Sequence[str]) -> Column:
    """Whether a page has nothing beside a name in front and page numbers; null counts as empty."""
    return remove_prefix(remove_footers(remove_space(F.coalesce(text, F.lit("")))), names) == ""


def count_literal(text: Column, needle: str) -> Column:
    """Occurrences of needle, apart (int; null: 0)."""
    text = F.coalesce(text, F.lit(""))
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def falsy(value: Column, default: Column) -> Column:
    """value, or default if it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), default)


def parse_flag(value: Column) -> Column:
    """Whether a parameter's text says yes; null doesn't."""
    return F.coalesce(F.lower(F.trim(value)).isin("1", "true", "yes", "on"), F.lit(False))


def first_group(text: Column, pattern: str) -> Column:
    """The first capture group of the first match; empty without one."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1)


def int_or_zero(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("int"), F.lit(0))


def round_half_even(value: Column) -> Column:
    return F.bround(value, 0).cast("long")


def round_one_decimal(value: Column) -> Column:
    """To one decimal (double), half to even, by the exact binary value: the fraction is taken as a whole number of 2**-59, so that no product is rounded before."""
    size = F.abs(value)
    tenths = ((size - F.floor(size)) * F.lit(float(2**59))).cast("long") * 10
    whole, rest, half = F.call_function("shiftright", tenths, F.lit(59)), F.pmod(tenths, F.lit(2**59)), F.lit(2**58)
    up = (rest > half) | ((rest == half) & (whole % 2 == 1))
    return (F.floor(size) * 10 + whole + up.cast("long")) / 10 * F.signum(value)


def stamp(time: Column) -> Column:
    """A point of time as file names have it."""
    return F.date_format(time, "yyyyMMdd_HHmmss")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end (timestamps without zone), half to even."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.bround(micros / F.lit(1e6), 0).cast("long")


def any_line_matches(lines: Column, pattern: str) -> Column:
    """Whether a line of an array matches, without regard to case; null lines don't, and no lines don't."""
    return F.coalesce(F.exists(lines, lambda x: F.coalesce(F.regexp_like(x, F.lit(f"(?i){pattern}")), F.lit(False))), F.lit(False))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def file_stem(path: Column) -> Column:
    """The file name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def parent_path(path: Column) -> Column:
    return F.regexp_replace(path, r"[/\\][^/\\]*$", "")


def with_extension(path: Column, extension: str) -> Column:
    return F.concat(F.regexp_replace(path, r"(?<=[^/\\])\.[^./\\]*$", ""), F.lit(extension))


def with_suffix(path: Column, suffix: str) -> Column:
    """The path with suffix between stem and extension; a path without a file name stays."""
    return F.regexp_replace(path, r"^(.*?[^/\\])(\.[^./\\]*)?$", f"$1{suffix}$2")


def _tidy(text: Column) -> Column:
    """Spacing and marks outside quotations."""
    out = F.regexp_replace(text, BLANKS, " ")
    # each pattern begins with the character that it is about and looks behind from there, so that it fails at once at all others
    out = F.regexp_replace(out, f" (?:(?<=[{HAN}] ) *(?=[{HAN}{ALNUM}])|(?<=[{ALNUM}] ) *(?=[{HAN}]))", "")


    def marked(x: Column) -> Column:
        out = F.regexp_replace(x, f"(?: (?<! {{2}}) *)?([{FULL_MARKS}]) *", "$1")
        for half, full in HALF_TO_FULL:
            out = F.regexp_replace(out, rf"\{half}(?<=[{HAN}]\{half})(?=[{HAN}])", full)
        return F.when(F.regexp_like(x, F.lit(MARKED)), out).otherwise(x)

    return F.transform(F.array(out), marked)[0]  # a variable, so that what goes before isn't done anew in each branch


def quoted_pieces(line: Column) -> Column:
    """A line in pieces: array<struct<text, quoted>>; quoted pieces are quotations with their marks, the outermost ones where they are nested. A mark without its counterpart quotes nothing.

    Two folds over what stands between marks, from the left for closing marks and from the right for opening ones, tell which have a counterpart; a third tells what stands within any.
    """
    pieces = F.filter(F.split(line, "(?=[“”])|(?<=[“”])"), lambda x: x != "")
    row = lambda text, on, off: F.struct(text.alias("text"), on.alias("opens"), off.alias("closes"))
    no = F.lit(False)
    plain = F.array().cast("array<struct<text:string,opens:boolean,closes:boolean>>")

    def marked(state: Column, x: Column) -> Column:  # a closing mark has its counterpart if one is open
        closes = (x == "”") & (state["depth"] > 0)
        depth = state["depth"] + F.when(x == "“", 1).when(closes, -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.array_append(state["out"], row(x, no, closes)).alias("out"))

    def opened(state: Column, x: Column) -> Column:  # from the right: an opening mark, if a closing one waits
        opens = (x["text"] == "“") & (state["depth"] > 0)
        depth = state["depth"] + F.when(x["closes"], 1).when(opens, -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.array_append(state["out"], row(x["text"], opens, x["closes"])).alias("out"))

    none = F.struct(F.lit(0).alias("depth"), plain.alias("out"))
    closed = F.aggregate(pieces, none, marked, lambda s: F.reverse(s["out"]))
    both = F.aggregate(closed, none, opened, lambda s: F.reverse(s["out"]))
    joined = F.array().cast("array<struct<text:string,quoted:boolean>>")

    def gathered(state: Column, x: Column) -> Column:  # neighbours of one kind make one piece, but for quotations side by side
        quoted = (state["depth"] > 0) | x["opens"]
        out = state["out"]
        last = F.element_at(out, -1)
        goes_on = (F.size(out) > 0) & F.when(quoted, state["depth"] > 0).otherwise(F.try_element_at(out, F.lit(-1))["quoted"] == no)
        piece = lambda text: F.struct(text.alias("text"), quoted.alias("quoted"))
        longer = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(piece(F.concat(last["text"], x["text"]))))
        depth = state["depth"] + F.when(x["opens"], 1).when(x["closes"], -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(goes_on, longer).otherwise(F.array_append(out, piece(x["text"]))).alias("out"))

    return F.aggregate(both, F.struct(F.lit(0).alias("depth"), joined.alias("out")), gathered, lambda s: s["out"])


#: Numbers of statutes' parts, in either script.
NUMBER = r"[\p{Nd}零〇一二三四五六七八九十百千两]+"
#: Headings of parts, chapters and sections, the whole line, which no sentence is; what stands in front of an article of a statute; page footers.
HEADING = rf"^第{NUMBER}[编章节](?:[ \x{{3000}}][^。，；：！？,;:!?]*)?$"
ARTICLE = rf"^第{NUMBER}条 +"
PAGE_FOOTER = r"^ *— *\p{Nd}+ *— *$"


def preserved_spans(line: Column) -> Column:
    """Spans of a line that proofing leaves as they are: array<struct<start, end>> in characters, from 0, end exclusive: the whole of a heading or page footer; an article's number; quotations; tabs. In order, apart but for neighbours."""
    whole = F.regexp_like(line, F.lit(f"{HEADING}|{PAGE_FOOTER}"))
    span = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    number = F.length(F.regexp_extract(line, ARTICLE, 0))
    none = F.array().cast("array<struct<start:int,end:int>>")
    # tabs are pieces of their own, as quotations are
    pieces = F.flatten(F.transform(quoted_pieces(F.regexp_replace(line, ARTICLE, "")), lambda p: F.when(p["quoted"], F.array(p)).otherwise(F.transform(F.split(p["text"], "(?=\t)|(?<=\t)"), lambda x: F.struct(x.alias("text"), (x == "\t").alias("quoted"))))))

    def step(state: Column, p: Column) -> Column:
        end = state["at"] + F.length(p["text"])
        return F.struct(end.alias("at"), F.when(p["quoted"] & (F.length(p["text"]) > 0), F.array_append(state["out"], span(state["at"], end))).otherwise(state["out"]).alias("out"))

    first = F.struct(number.alias("at"), F.when(number > 0, F.array(span(F.lit(0), number))).otherwise(none).alias("out"))
    return F.when(whole, F.array(span(F.lit(0), F.length(line)))).when(line.isNotNull(), F.aggregate(pieces, first, step, lambda s: s["out"]))


def cjk_normalise(line: Column) -> Column:
    """A line with the spacing and punctuation of Chinese typesetting.

    Spaces between Han characters, or these and letters or digits, and around full-width marks go; half-width marks between Han
    characters become full-width. Headings of statutes (parts, chapters, sections; whole lines without a sentence), page footers and quotations (nested ones too; a mark without its counterpart quotes nothing) stay as they
    are, and so do tabs; of an article of a statute its number and the space behind it stay, and its text is corrected. Spaces beside a quotation go. Doing it again changes nothing.
    """
    numbered = F.startswith(line, F.lit("第"))
    keep = (numbered | F.contains(line, F.lit("—"))) & F.regexp_like(line, F.lit(f"{HEADING}|{PAGE_FOOTER}"))
    number, rest = F.when(numbered, F.regexp_extract(line, ARTICLE, 0)).otherwise(F.lit("")), F.when(numbered, F.regexp_replace(line, ARTICLE, "")).otherwise(line)

    def tidied(pieces: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            text = _tidy(p["text"])
            text = F.when(i > 0, F.regexp_replace(text, "^ +", "")).otherwise(text)
            return F.when(p["quoted"], p["text"]).otherwise(F.when(i < F.size(pieces) - 1, F.regexp_replace(text, " +$", "")).otherwise(text))

        return F.array_join(F.transform(pieces, one), "")

    def done(rest: Column) -> Column:
        # within the transform, the pieces are a variable: they aren't made anew for each of them; most lines have no mark at all
        quoted = F.transform(F.array(quoted_pieces(rest)), tidied)[0]
        return F.when(F.contains(rest, F.lit("“")) | F.contains(rest, F.lit("”")), quoted).otherwise(_tidy(rest))

    return F.when(keep, line).otherwise(F.concat(number, F.transform(F.array(rest), done)[0]))


#: Rules of the proof report and their patterns (ours, after the stated rules).
PROOF_RULES = {
    "extra_space": f"(?<=[{HAN}]) +(?=[{HAN}{ALNUM}])|(?<=[{ALNUM}]) +(?=[{HAN}])|(?<=[{FULL_MARKS}]) +| +(?=[{FULL_MARKS}])",
    "special_blank": BLANKS,
    "half_width_mark": f"(?<=[{HAN}])[,;:?!](?=[{HAN}])",
}

#: Common surnames and last characters of units' names (ours): what tells a name in brackets from a remark.
SURNAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林高罗郑梁谢宋唐许邓韩冯曹彭曾肖田董潘袁蔡蒋余于杜叶程魏苏吕丁任卢姚沈钟姜崔谭陆范汪廖石金韦贾夏付方邹熊白孟秦邱侯江尹薛闫雷龙黎史陶贺毛郝顾龚邵万覃武钱戴严莫孔向汤"
UNITS = "局院厅中心社报部委处科会所站司校组网大学"
_NAME = rf"(?:(?:记者|通讯员|作者|编辑)[ ：:]*)?[{SURNAMES}][{HAN}]{{1,3}}"
_UNIT = rf"[{HAN}]+[{UNITS}]"
_SIGNED = rf"(?:{_NAME}|{_UNIT})(?:[ 、/]+(?:{_NAME}|{_UNIT}))*"
#: Sign-offs at the end of an article (ours, after the stated rules): names or units in brackets, photo credits, captions. Credits end with their mark and, like captions, hold no end of a sentence before it.
#: Each is the whole paragraph, and has one of the characters in front of it here, which are looked for first.
SIGN_OFFS = {
    ("（", "("): rf"(?:（{_SIGNED}）|\({_SIGNED}\))",
    ("摄", "供图"): rf"[^。！？；，]*(?:[/／]摄|供图|摄影)[^{HAN}。！？；，]*",
    ("图为", "图：", "图:"): r"图[为：:][^。！？；]*。?",
}
#: The same in brackets behind the last sentence: after its end mark, so that no title or term loses what belongs to it.
TRAILING_SIGN_OFF = rf"(?<=[。！？…”』」.!?]){WS}*(?:（{_SIGNED}）|\({_SIGNED}\)){WS}*$"
POINTERS = "详见|见下表|见附件|附后"


def is_sign_off(paragraph: Column) -> Column:
    """Whether a paragraph looks like nothing but a sign-off; pointers to tables and the like don't. What it is depends on where it stands: see operators.articles."""
    kinds = [reduce(or_, [F.contains(paragraph, F.lit(m)) for m in marks]) & F.regexp_like(paragraph, F.lit(f"^{WS}*{kind}{WS}*$")) for marks, kind in SIGN_OFFS.items()]
    return reduce(or_, kinds) & ~F.regexp_like(paragraph, F.lit(POINTERS))


def strip_sign_off(paragraph: Column) -> Column:
    """Without a name or unit in brackets behind the last sentence; for the last paragraph of an article."""
    return F.regexp_replace(paragraph, TRAILING_SIGN_OFF, "")


#: Lines that are nothing but furniture of a page (ours): anchored at both ends, so that no sentence of the text can match.
FURNITURE = rf"^{WS}*(?:扫一扫[^。！？，]*(?:打开|关注|分享)[^。！？，]*|打印本页|关闭窗口|字号：[^。！？，]*|分享到：?[^。！？，]*){WS}*$"


def is_furniture(line: Column) -> Column:
    return F.regexp_like(line, F.lit(FURNITURE))
