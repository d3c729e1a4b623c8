"""How the labelled table of page blocks was made: rules that were reviewed by eye on pages of ten sites.

Nothing of this takes part when pages are classified; it is kept so that the table can be made again from
other pages. The rules know the headings, boxes, marks and notices of the test pages by heart, which the
classifier's features do not: it has to tell them apart by counts, form and neighbours.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np

from pollweave.llm import boilerplate

# Labelled short blocks. Headings belong to articles; the others are a site's own.
HEADINGS = """概要|二次设定|名字的由来|音乐|轶事|登场经历|注释|考据|人际关系|历届名次|能力与弹幕|二次創作での設定|人物関係|名前の由来|楽曲|余談|歴代順位|能力|考察|登場歴
|登場作品|注釈|登場|音楽|設定|脚注|Overview|Trivia|Abilities|Relations|Name|Music|Analysis|Appearances|Notes|Fan lore|Past ranks""".replace("\n", "")
BOXES = """热门条目|大家都在看|你知道吗|猜你喜欢|本周榜单|相关推荐|今日推荐|週間ランキング|人気の記事|おすすめ|関連ページ|今日の一枚|豆知識|ご存じですか|こちらもおすすめ|Trending|Picture of the day|Related pages
|Did you know|You may also like|Weekly ranking|Popular pages""".replace("\n", "")
MARKS = """[编辑]|[編集]|[edit]|返回顶部|短网址 复制|展开全部|加载更多|广告|点击查看大图|本段内容有争议，请到讨论页发言|ページの先頭へ戻る|短縮URL コピー|広告|もっと見る|画像を拡大|シェア ツイート風 リンク|Back to top
|Share Copy link|Advertisement|Read more|Click to enlarge|跳到导航 跳到搜索|ナビゲーションに移動 検索に移動|Jump to navigation Jump to search|本页面词条尚未完工。|この項目は書きかけです。|This article is a stub.|You are viewing an old revision""".replace("\n", "")
# Labelled sentences of articles that read like notices.
SENTENCES = "她把版权页撕下来折成纸鹤，说这是自己的隐私。|She folds the copyright page into cranes and calls it her privacy policy."
# Words of site notices that are whole sentences.
NOTICE = re.compile(r"cookie|small files on your|データを保存|similar technolog|技術|浏览器里|端末に|継続|维护|メンテナンス|maintenance|ようこそ|欢迎来到|welcome to|除特殊注明|特に記載|available under|编辑前请|旧版本|古い版|old revision|最后编辑|最終更新|last edited|访问\d|閲覧され|been accessed|©|\(c\) ?\d|加入编辑组|编辑规范|stub|书きかけ|查看最新版|讨论页发言", re.I)
_KIND = {**dict.fromkeys(HEADINGS.split("|"), 2), **dict.fromkeys(BOXES.split("|"), -2), **dict.fromkeys(MARKS.split("|"), -1), **dict.fromkeys(SENTENCES.split("|"), 1)}
_PIECES = re.compile(r"\s*[|>·<]\s*|\s{2,}|\s+")
_WORD = re.compile(r"[A-Za-zÀ-ÿ'’]+|\d+|[가-힣]+|[぀-ヿ]|[㐀-鿿]")
_STOP = "。！？!?.～♪…」”』\"）)"
_SENTENCE = re.compile(r"[。！？!?～♪]|\.{3}|…+|\.(?=[\s」”\"']|$)")
_FAN = ("同人作品里", "In fan stories", "二次創作では")  # Fixed values: article sentences that may speak of cookies
_TITLE_TAIL = re.compile(r"\s*(?:/[^/]{1,12}|[（(][^（()）]{1,16}[)）]|\s[-–—]\s.{1,30})$")
_CLAUSE = re.compile(r"[、，,：:（）()「」“”\s]+")
_BULLET = re.compile(r"^\s*(?:[>*•·\-–—◆■●]|\d+[.)、])\s*")
_DIGIT = re.compile(r"\d")
_QUOTED = re.compile(r"^\s*[「“『\"]")

RULE_FEATURES = (
    "words", "link_density", "pieces", "ends", "cut", "kind", "notice", "subject", "title", "entry", "bullet", "numbered", "quoted", "digits",
    "prev_words", "prev_density", "prev_subject", "prev_kind", "prev_ends", "next_words", "next_density", "next_subject", "next_kind", "next_ends",
    "since_box", "since_heading", "after_first", "before_last", "near", "named",
)


def _form(line: str) -> str:
    return " ".join(line.split())


def _entry(body: str) -> bool:
    """A list entry that names its topic and goes on about it: ``X: ... X ...``."""
    head, colon, tail = body.replace(": ", "：", 1).partition("：")
    return bool(colon) and 1 < len(head) <= 40 and head in tail


def kinds_of(forms: Sequence[str]) -> list[int]:
    """What the labelled short blocks say of each block: 2 heading, 1 sentence, 0 nothing, -1 mark, -2 box,
    -3 a heading's words that no text follows (menus use some of them)."""
    kinds = [_KIND.get(f, 0) for f in forms]
    solid = [i for i, f in enumerate(forms) if f and kinds[i] != -1]
    for i, j in zip(solid, [*solid[1:], -1], strict=False):
        if kinds[i] == 2:
            f = forms[j] if j >= 0 else ""
            text = len(f) >= 12 and _SENTENCE.search(f) and not NOTICE.search(f)
            if not (kinds[j] in (1, 2, -2) if j >= 0 and kinds[j] else text or _entry(_BULLET.sub("", f)) or f.startswith(_FAN)):
                kinds[i] = -3
    return kinds


def subject_of(lines: Sequence[str]) -> tuple[str, int]:
    """What the page speaks of and the block that is its title: ``('', -1)`` if it has neither.

    The subject is the title-like block found in most sentences, if it stands before a heading or a
    sentence about it, or in a breadcrumb; else the phrase that most sentences under headings share.
    """
    forms = [_form(x) for x in lines]
    kinds = kinds_of(forms)
    told = [i for i, f in enumerate(forms) if len(f) >= 12 and kinds[i] == 0 and _SENTENCE.search(f) and not _entry(_BULLET.sub("", f))]
    solid = [i for i, f in enumerate(forms) if f and kinds[i] != -1]
    follow = dict(zip(solid, solid[1:], strict=False))
    under = {follow[i] for i in solid if kinds[i] == 2 and i in follow} & set(told)
    boxed, inside = {}, False
    for i in solid:
        inside = kinds[i] == -2 or inside and kinds[i] != 2
        boxed[i] = inside
    best = ("", -1, 0.0)
    for i in solid:
        f = forms[i]
        if kinds[i] or len(f) > 70 or len(f) < 2:
            continue
        crumb = " < " in f
        c = f.rsplit(" < ", 1)[1] if crumb else f
        if _SENTENCE.search(c) or "|" in c and " | " in c or _BULLET.match(c) or c[-1] in ">：:":
            continue
        nxt = follow.get(i, -1)
        for name in dict.fromkeys((c, _TITLE_TAIL.sub("", c))):
            if not 1 < len(name) <= 40:
                continue
            n = sum(name in forms[j] for j in told if crumb or j > i)
            direct = nxt >= 0 and (kinds[nxt] == 2 or nxt in told and name in forms[nxt])
            score = n + 1.5 * direct + 0.5 * (name != c) + 0.5 * crumb
            fits = not under or any(name in forms[j] for j in under)
            lone = nxt >= 0 and not under and (kinds[nxt] == 2 or _entry(_BULLET.sub("", forms[nxt])) and not boxed[i])
            if (direct or crumb or n > 1 or lone) and (n or lone or name != c and direct) and (fits or n > len(under)) and score > best[2]:
                best = (name, -1 if crumb else i, score)
    if best[0]:
        name, at, _ = best
        if at < 0:  # a breadcrumb names the subject; the title may stand below it
            at = next((i for i in solid if " < " not in forms[i] and _TITLE_TAIL.sub("", forms[i]) == name), -1)
        return name, at
    first = min((i for i in solid if kinds[i] == 2), default=-1)
    runs: list[list[int]] = [[]]
    for i in solid:  # the longest stretch of sentences and entries
        if i in told or _entry(_BULLET.sub("", forms[i])):
            runs[-1].append(i)
        elif runs[-1]:
            runs.append([])
    run = [i for i in max(runs, key=len) if i in told]
    for zone, share in ((sorted(under), 0.6), ([j for j in told if j > first >= 0 and not boxed[j]], 0.6), (run, 0.5)):
        sents = [s for j in zone for s in _SENTENCE.split(forms[j]) if len(s) > 6]
        if len(sents) < 3:
            continue
        grams: Counter = Counter()
        for s in sents:
            words = re.findall(r"[A-ZÀ-Þ][\w'’]*(?:\s[A-ZÀ-Þ]\w*)+", s)
            grams.update(set(words) if words else {x[i : i + n] for x in _CLAUSE.split(s) for n in (3, 4, 5, 6, 8, 10) for i in range(len(x) - n + 1)})
        top, n = max(grams.items(), key=lambda x: (x[1], len(x[0])), default=("", 0))
        if n >= max(3, share * len(sents)):
            return top, -1
    return "", -1


def rule_features(text: str) -> np.ndarray:
    """One row of RULE_FEATURES per line of ``text`` (split at line feeds)."""
    lines = text.split("\n")
    n = len(lines)
    sub, title_at = subject_of(lines)
    base = np.zeros((n, 14))
    known = kinds_of([_form(x) for x in lines])
    for i, raw in enumerate(lines):
        line = _form(raw)
        words = len(_WORD.findall(line))
        parts = [p for p in _PIECES.split(line) if p]
        short = sum(len(p) for p in parts if len(p) <= 16 and not _SENTENCE.search(p)) if len(parts) > 1 else 0
        density = short / max(1, sum(map(len, parts)))
        if len(parts) == 1 and words <= 8 and line[-1:] not in _STOP:
            density = 1.0
        bullet = _BULLET.match(line)
        body = _BULLET.sub("", line)
        has = bool(sub) and sub.lower() in line.lower()
        base[i] = (
            words, density, len(parts), line[-1:] in _STOP and line != "", bool(re.search(r"(?:…|\.\.\.)$", line)), known[i], bool(NOTICE.search(line)) and not has or " < " in line, has and " < " not in line,
            i == title_at, _entry(body), bool(bullet), bool(bullet) and line[:1].isdigit(), bool(_QUOTED.match(body)), len(_DIGIT.findall(line)) / max(1, len(line)),
        )
    kind, subj, ends, words = base[:, 5], base[:, 7], base[:, 3], base[:, 0]
    sentence = (ends > 0) & (words >= 6)
    core = np.flatnonzero(((subj > 0) & sentence) | (kind == 2) | ((base[:, 9] > 0) & sentence))
    out = np.zeros((n, len(RULE_FEATURES)))
    out[:, :14] = base
    # neighbours: the nearest blocks that are not edit marks or blank
    solid = [i for i in range(n) if kind[i] != -1 and words[i] + base[i, 2] > 0]
    prev = {b: a for a, b in zip(solid, solid[1:], strict=False)}
    follow = {a: b for a, b in zip(solid, solid[1:], strict=False)}
    last_solid, box, heading = -1, 99, 99
    for i in range(n):
        p = prev.get(i, last_solid if i not in prev else -1)
        q = follow.get(i) if i in follow else next((j for j in solid if j > i), -1) if kind[i] == -1 or words[i] == 0 else -1
        for at, j in ((14, p), (19, q)):
            out[i, at : at + 5] = (words[j], base[j, 1], subj[j], kind[j], ends[j]) if j is not None and j >= 0 else (-1, -1, -1, -9, -1)
        if i in prev or i in follow:
            last_solid = i
        box, heading = (0, heading) if kind[i] == -2 else (box, 0) if kind[i] == 2 else (box + 1, heading + 1)
        if kind[i] == 2 or (subj[i] and sentence[i]):
            box = 99
        out[i, 24], out[i, 25] = min(box, 99), min(heading, 99)
    if len(core):
        pos = np.arange(n)
        out[:, 26], out[:, 27] = pos - core[0], core[-1] - pos
        out[:, 28] = np.abs(pos[:, None] - core[None, :]).min(axis=1)
    else:
        out[:, 26:29] = -99, -99, 99
    out[:, 29] = bool(sub)
    return out


_AT = {n: i for i, n in enumerate(RULE_FEATURES)}


def labels(text: str, x: np.ndarray | None = None) -> np.ndarray:
    """1 for each block that is main content: headings with text, known sentences, sentences about the
    subject, list entries, other sentences below a heading, and the title if there is an article."""
    x = rule_features(text) if x is None else x
    f = {n: x[:, i] for n, i in _AT.items()}
    y = np.zeros(len(x), int)
    inside = False
    for i, line in enumerate(text.split("\n")):
        if not line.strip():
            continue
        kind = f["kind"][i]
        if kind in (1, 2):
            y[i] = 1
            inside = inside or kind == 2
        elif kind == -2:
            inside = False
        elif kind == 0 and not f["notice"][i] and f["ends"][i] and f["words"][i] >= 6:
            about = f["subject"][i] or f["entry"][i] and not f["numbered"][i]
            y[i] = bool(about or inside and f["link_density"][i] < 0.5 and f["words"][i] >= 8)
            inside = inside or bool(f["subject"][i])
    if y.any():
        y[f["title"] > 0] = 1
    return y


def write_table(texts: Sequence[str], path: str, known: Mapping[str, Sequence[float]], rows: int = 15000, bare: int = 5000, seed: int = 0) -> int:
    """Writes distinct feature rows with their labels: at most ``rows`` with what is ``known`` of repeated blocks
    and ``bare`` without (as on pages of a site met for the first time); gives their number."""
    out = []
    for stats, most in ((known, rows), ({}, bare)):
        seen = {}
        for at, part in boilerplate._chunks(texts):
            b, x = boilerplate.features(part, stats)
            y = np.concatenate([labels(t) for t in part])
            seen |= dict.fromkeys((*r, int(c)) for r, c in zip(x[b.solid].tolist(), y[b.solid].tolist(), strict=True))
        keys = list(seen)
        pick = np.random.default_rng(seed).permutation(len(keys))[:most]
        out += [keys[i] for i in pick]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow([*boilerplate.FEATURES, "content"])
        w.writerows([int(v) if v == int(v) else v for v in r] for r in out)
    return len(out)
