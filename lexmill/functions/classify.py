"""What a byline or note is about: publication, imprint, lecture, scribe, author, provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import strip

#: Labels of the six kinds, of several, of none, and of an empty text.
KINDS = ("刊载出处", "印行信息", "讲演信息", "记録者", "作者署名", "出处说明")
SEVERAL, OTHER, EMPTY = "综合", "其他", "空"
#: Words of printing; words of provenance; words that tell a note is on publication.
IMPRINT = "印行 印本 流通本 單行本 印刷 印發 油印".split()
PROVENANCE = "原題 改題 附註 附注 原名 原題為 題作 署名 刊載 轉載 登載 載於 今依 今仍 今改 此係 初版 再版 重版".split()
PUBLICATION = (
    "刊載 刊载 海刊 改題 原題 出版 印行 轉載 登載 初版 再版 發行 編入 流通 載於 單行本 流通本 題作 署名 原題為 原題作 今改 今仍 今依 此處 "
    "原見 原載 錄自 選自 節自 出「 出自 見海刊 見海潮音 見覺 見正信 見佛教 見居士 見林刊 見朝日 原刊"
).split()


def any_of(text: Column, words: list[str]) -> Column:
    """Whether a text contains one of some words; null contains none."""
    return F.coalesce(reduce(lambda a, b: a | b, (text.contains(w) for w in words)), F.lit(False))


def about_publication(text: Column, words: list[str] = PUBLICATION) -> Column:
    """Whether a note tells of publication."""
    return any_of(text, words)


def kind_label(text: Column, flags: list[Column], fallbacks: list[tuple[Column, str]] = (), kinds=KINDS, several=SEVERAL, other=OTHER, empty=EMPTY) -> Column:
    """The one kind whose flag is set; ``several`` for more; without any the first fallback that holds."""
    n = reduce(lambda a, b: a + b, (f.cast("int") for f in flags))
    one = F.lit(None).cast("string")
    for flag, kind in reversed(list(zip(flags, kinds, strict=True))):
        one = F.when(flag, kind).otherwise(one)
    rest = F.lit(other)
    for holds, kind in reversed(list(fallbacks)):
        rest = F.when(holds, kind).otherwise(rest)
    return F.when(text == "", empty).when(n >= 2, several).when(n == 1, one).otherwise(rest)


#: For each kind the patterns that tell of it, \d and \s in the wide sense; the kinds without patterns go by words.
PATTERNS = {
    "刊载出处": (
        r"[（(][见見錄录出]",
        r"^[见見錄录出]",
        r"^[原并並散]?[见見]",
        r"[)）]\s*[原并並散]?[见見]",
        r"[刊载載刊轉转登][載载刊登]",
    ),
    "讲演信息": (
        r"——|──",
        r"(民國|宣統)?\d+年.*?(在|於|作|編|講|述|記)",
    ),
    "记録者": (r"[（(][^)）]*[記记]",),
    "作者署名": (
        r"太虛[識撰跋敘序記附書簽]|釋太虛|雪山太虛",
        r"(?<![，,])太虛[，,、]",
        r"^[（(]?太虛",
        r"^[（(]?(民國|民|佛曆|佛)[\d一二三四五六七八九十百千]+年",
        r"^[（(]?[廿卅第]?[\d一二三四五六七八九十百千万廿卅]+[，,\s]*年?[，,\s]*[\d一二三四五六七八九十廿卅]+[，,\s]*月?[\d一二三四五六七八九十廿卅]+[日，,\s]",
    ),
}
#: What decides where no kind is told, in this order.
FALLBACKS = (
    (r"[見见].*[刊报報叢书書集鈔钞誌志月周旬]", "刊载出处"),
    (r"^[（(].{1,12}[)）]$", "记録者"),
)


def classify_byline(
    raw: Column, sources: tuple[str, ...] = (), patterns: dict[str, tuple[str, ...]] = PATTERNS, words: dict[str, list[str]] | None = None, fallbacks: tuple = FALLBACKS
) -> Column:
    """The kind of a byline or note: of the kinds that some pattern or word tells, the one, or SEVERAL; of none the first fallback that holds, or OTHER.

    ``sources`` are names of periodicals that tell of publication on their own. Null and blank texts are EMPTY.
    """
    t = strip(F.coalesce(raw, F.lit("")))
    words = {KINDS[1]: IMPRINT, KINDS[5]: PROVENANCE} if words is None else words
    tests = lambda kind: [t.rlike("(?U)" + p) for p in patterns.get(kind, ())] + ([any_of(t, words[kind])] if kind in words else [])
    told = lambda kind: reduce(lambda a, b: a | b, tests(kind), F.lit(False))
    rest = [(t.rlike(p), kind) for p, kind in fallbacks]
    if sources:
        rest.append((any_of(t, [s for s in sources if len(s) >= 2]), KINDS[0]))
    return kind_label(t, [told(kind) for kind in KINDS], rest)
