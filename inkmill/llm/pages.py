"""Problem 6: the body of a page without its furniture, by composite text density.

A page is a tree of nodes with characters, tags and links: an HTML page by its markup, a page that has come down to lines by these, a
line being a leaf and its separated items its tags. The word lists only tell which items are links where no markup does.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import take
from .residue import kind
from .text import CJK, fold

# What links in menus of wikis and story sites say, folded.
MENU = frozenset(
    x
    for line in """
home|main page|help|log in|login|sign in|sign up|register|contact|contact us|about|about us|forum|forums|discord|donate|search|menu|blog|news|shop|store
recent changes|random page|categories|community portal|wiki tools|rankings|timeline|magic items|bestiary|classes|races|novels|maps|all pages|special pages|faq|rss
inicio|portada|ayuda|acceder|iniciar sesión|contacto|foro|mapas|razas|clases|clasificación|bestiario|página aleatoria|cambios recientes|categorías|cronología|novelas|donar|buscar|personajes|pueblos
accueil|aide|connexion|s'identifier|contact|forum|cartes|peuples|races|classes|classement|bestiaire|page au hasard|modifications récentes|catégories|chronologie|romans|faire un don|rechercher
startseite|hauptseite|hilfe|anmelden|registrieren|kontakt|forum|karten|völker|klassen|rangliste|bestiarium|zufällige seite|letzte änderungen|kategorien|zeitleiste|romane|spenden|suche
ホーム|トップ|トップページ|メインページ|ヘルプ|ログイン|新規登録|お問い合わせ|掲示板|フォーラム|地図|種族|職業|ランキング|魔物図鑑|おまかせ表示|最近の更新|カテゴリ|年表|小説|寄付|検索|マイページ
首页|主页|帮助|登录|注册|联系我们|论坛|地图|种族|职业|排行榜|怪物图鉴|随机页面|最近更改|最近更新|分类|时间线|小说|捐助|搜索|书架|社区
view source|history|discuss|talk|edit|read|print|mail|copy link|share|link|previous chapter|contents|next chapter|previous|next|imprint|sitemap|privacy policy|terms of use|terms|privacy|manage|reject|accept
mentions légales|plan du site|confidentialité|précédent|suivant|sommaire|paramétrer|courriel|lien|imprimer|aviso legal|privacidad|mapa del sitio|anterior|siguiente|índice|configurar|correo|enlace|imprimir
impressum|datenschutz|nutzungsbedingungen|zurück|weiter|inhalt|einstellungen|drucken|利用規約|運営会社|プライバシー|プライバシーポリシー|前へ|次へ|目次|設定|メール|リンク|印刷|使用条款|隐私政策|关于我们|上一章|下一章|目录|设置|邮件|链接|打印
""".split("\n")
    for x in line.split("|")
    if x
)
# Whole lines of furniture, folded.
FURNITURE = re.compile(
    r"(?:skip|jump) to (?:main )?(?:content|navigation|search)|back to top|return to top|^top$"
    r"|.*\bcookies?\b.*(?:\||accept|agree|consent|experience|settings:|\[save\]|your device).*|.*\b(?:accept|reject) (?:all|/).*|your privacy matters to us.*|this site (?:stores|uses) cookies.*"
    r"|powered by \S+.*|hosted by .{1,80}report a problem\.?|(?:copyright|©|\(c\)) ?(?:©|\(c\))? ?\d{4}.*|content is available under .*|all rights reserved\.?|(?:this page was )?last (?:edited|modified|updated)\b.{0,60}"
    r"|advertisement|sponsored(?: content)?(?::.*)?|subscribe to (?:our|the) .*|sign up for our .*|follow .{1,80} for updates|rate this (?:entry|page|chapter|story):?.*|share this (?:page|story|chapter|article)\b.*"
    r"|\d+ comments?\b.{0,40}|(?:sign|log) in to (?:reply|comment).{0,20}|you might also like:.*|related (?:pages|articles|stories):.*|popular (?:this week|today|now|pages):.*|tags: .*|read next:.*|view source \| .*"
    r"|privacy policy .{0,4}terms of use.*|add to (?:library|favourites|favorites|bookshelf)|report (?:a problem|chapter|this page)|toggle navigation|loading\.\.\.|(?:show|leave a) comments?"
    r"|ir al contenido|volver arriba|al continuar acepta .*cookies\.?|usamos cookies.*|publicidad|suscríbase .*|compartir:.*|\d+ comentarios?\b.*|páginas relacionadas:.*|última edición:.*|etiquetas: .*|también te puede gustar:.*|© ?\d{4}.*|siga a .* para novedades|aviso legal .*"
    r"|aller au contenu|haut de page|en poursuivant, vous acceptez .*cookies\.?|nous utilisons des cookies.*|publicité|inscrivez-vous à .*|partager ?:.*|\d+ commentaires?\b.*|articles liés ?:.*|dernière modification le .*|étiquettes ?: .*|vous aimerez aussi ?:.*|mentions légales .*"
    r"|zum inhalt(?: springen)?|nach oben|mit der nutzung stimmen sie .*cookies zu\.?|wir verwenden cookies.*|werbung|anzeige|newsletter abonnieren|teilen:.*|\d+ kommentare?\b.*|verwandte seiten:.*|zuletzt (?:bearbeitet|geändert) am .*|schlagwörter: .*|das könnte (?:sie|dir) auch .*|impressum .{0,4}datenschutz.*"
    r"|本文へ(?:移動|スキップ)?|.*(?:クッキー|cookie).*同意.*|(?:ページの|この)?(?:先頭|トップ)へ(?:戻る)?|ページの先頭へ|.*(?:クッキー|cookie)を?(?:使用|利用).*|広告|(?:共有|シェア)[:：].*|コメント\d+件.*|ログインして返信|関連ページ[:：].*|最終更新[:：].*|タグ[:：].*|お気に入りに(?:登録|追加)|メールマガジン.*|おすすめ[:：].*"
    r"|跳到(?:正文|内容)|返回顶部|回到顶部|.*(?:继续浏览即表示|使用 ?cookie|同意使用 ?cookie).*|广告|分享[:：].*|\d+条评论.*|登录后回复|相关(?:页面|条目)[:：].*|本页最后编辑于.*|最后(?:编辑|更新).{0,24}|标签[:：].*|加入书架|订阅.{0,20}|猜你喜欢[:：].*|热门[:：].*|使用条款 .*"
)
_SEPARATORS = re.compile(r"\s*[|｜·•»›>/←→‹«]\s*|\s+・\s+|\s{2,}|\s+[-–—]\s+")
#: What is furniture on any site, whatever its words and its language.
_ALWAYS = re.compile(r".*\bcookies?\b.*(?:\||accept|agree|settings:|your device).*|(?:copyright|©|\(c\)) ?(?:©|\(c\))? ?\d{4}.*")
_DIGIT = re.compile(r"\d")
_BULLET = re.compile(r"^\s*(?:[*+\-•·]|\d+[.)])\s+")
_STOP = re.compile(r"[.!?。！？…][\"'”»」)]?\s*$")


#: Longest item of a row of links; shortest line that can be running text (half of that in scripts without spaces).
ITEM_CHARS, TEXT_CHARS = 30, 40
_BLOCKS = re.compile(r"<(?:html|body|div|p|td|article|section|main|li)\b", re.I)


class Leaf:
    """Characters and tags of a leaf or of a node of a page, and those of them that belong to links."""

    __slots__ = ("text", "chars", "tags", "link_chars", "link_tags", "density")

    def __init__(self, text: str = "", chars: int = 0, tags: int = 1, link_chars: int = 0, link_tags: int = 0):
        self.text, self.chars, self.tags, self.link_chars, self.link_tags, self.density = text, chars, tags, link_chars, link_tags, 0.0

    @property
    def links(self) -> bool:
        """Whether at least half of it is links."""
        return self.link_tags > 0 and 2 * self.link_chars >= self.chars


def composite(node: Leaf, page: Leaf) -> float:
    """The composite text density of a node: its characters per tag, brought down by its share of links."""
    c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), node.link_tags
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + page.link_chars / max(1, page.chars) * c + math.e)
    return c / t * math.log(max(1.0, c / max(1, lc) * t / max(1, lt))) / base


def leaf(raw: str, listed: bool = True) -> Leaf:
    """A line as a leaf: the items of a row of short ones, and what the lists know, are links; ``listed`` tells whether to ask the lists."""
    text = fold(raw).replace("’", "'").replace("​", "").strip()
    bare = _BULLET.sub("", text)
    items = [x for x in _SEPARATORS.split(bare) if x]
    whole = bool((FURNITURE if listed else _ALWAYS).fullmatch(text) or listed and FURNITURE.fullmatch(bare))
    known = [x for x in items if x.strip(" :：[]") in MENU] if listed else []
    row = len(items) > 2 and max(map(len, items)) <= ITEM_CHARS and not _STOP.search(text) and not _DIGIT.search(text)
    if whole or row or bare in MENU and listed:
        return Leaf(text, len(text), max(1, len(items)), len(text), max(1, len(items)))
    if known and len(known) >= len(items) - 1 and (len(items) > 2 or len(known) == 2 or items[0] in MENU) or 2 * len(known) >= len(items) > 1:
        share = 1 if len(known) >= len(items) - 1 else sum(map(len, known)) / sum(map(len, items))
        return Leaf(text, len(text), len(items), int(len(text) * share), len(known))
    return Leaf(text, len(text))


def furniture_lines(page: str | None, listed: bool = True) -> list[int]:
    """Numbers (from 1) of the lines of a text that aren't part of its body; none for a text that isn't a page with furniture.

    The lines are the leaves of the page. Of all runs of lines the one with the largest sum of composite densities, each less
    the threshold, is the body; the threshold is the smallest density on the path from it to the root, which is the page's own or
    that of its densest leaf. Within the body only links are furniture, but for a single word that stands right above a dense
    line, as its heading does. Before and after it furniture is what is links, what stands on the far side of such lines as
    seen from the body, and three or more short lines in a row; the rest are titles, tables and lists of the body. A text
    without any links, or with no line long enough for running text, isn't a page with furniture.
    """
    if not isinstance(page, str) or "\n" not in page:
        return []
    leaves = [leaf(x, listed) for x in page.split("\n")]
    filled = [i for i, x in enumerate(leaves) if x.text]
    links = [i for i in filled if leaves[i].links]
    if not links or len(links) == len(filled) or len(links) == 1 and leaves[links[0]].text in MENU:
        return []
    if max(x.chars * (2 if CJK.search(x.text) else 1) for x in leaves) < TEXT_CHARS:
        return []
    root = Leaf("", *(sum(getattr(leaves[i], k) for i in filled) for k in ("chars", "tags", "link_chars", "link_tags")))
    for i in filled:
        leaves[i].density = composite(leaves[i], root)
    threshold = min(composite(root, root), max(leaves[i].density for i in filled))
    best, total, begin, first, last = -1.0, 0.0, filled[0], filled[0], filled[-1]
    for i in filled:
        if total <= 0:
            total, begin = 0.0, i
        total += leaves[i].density - threshold
        if total > best:
            best, first, last = total, begin, i
    below = dict(zip(filled, filled[1:]))
    out = {
        i for i in links
        if not (first < i < last and leaves[i].tags == 1 and leaves[i].text in MENU and leaves[below[i]].density >= threshold)
    }
    if not out:
        return []
    ahead, behind = [i for i in filled if i < first], [i for i in filled if i > last]
    row: list[int] = []
    for i in [*ahead, first]:
        x = leaves[i]
        if i < first and i not in out and x.chars <= ITEM_CHARS and not _STOP.search(x.text) and not _DIGIT.search(x.text):
            row.append(i)
            continue
        if len(row) > 2:
            out.update(row)
        row = []
    marked = sorted(out)
    out.update(i for i in ahead if sum(i < j < first for j in marked) > 1)
    out.update(i for i in behind if any(last < j < i for j in marked))
    return [i + 1 for i in sorted(out)]


class _Dom(HTMLParser):
    """The nodes of a page, each a ``Leaf`` with its children and its own text; scripts and styles are left out."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root: list = ["", []]  # tag, children; a text is a child too
        self.path = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag: str, attrs: object) -> None:
        node = [tag, []]
        self.path[-1][1].append(node)
        if tag not in self.VOID:
            self.path.append(node)

    def handle_endtag(self, tag: str) -> None:
        at = next((k for k in range(len(self.path) - 1, 0, -1) if self.path[k][0] == tag), None)
        if at is not None:
            del self.path[at:]

    def handle_data(self, data: str) -> None:
        if data.strip() and not {"script", "style", "noscript", "template"} & {x[0] for x in self.path}:
            self.path[-1][1].append(data)


def dom_body(page: str) -> str:
    """The text of the body of an HTML page: of all nodes the one whose children's densities have the largest sum.

    Of its nodes, those stay whose density is no less than the threshold, the smallest density on the path from that node to the
    root, and of the others the parts that do; text of the node itself and of inline elements stays with it.
    """
    nodes: list[tuple[list, Leaf, list[Leaf]]] = []
    order, todo = [], [_Dom(page).root]
    while todo:  # parents before children, without recursion
        node = todo.pop()
        order.append(node)
        todo += [x for x in node[1] if isinstance(x, list)]
    measure: dict[int, Leaf] = {}
    for node in reversed(order):
        inside = [measure[id(x)] for x in node[1] if isinstance(x, list)]
        chars = sum(len("".join(x.split())) for x in node[1] if isinstance(x, str)) + sum(x.chars for x in inside)
        whole = node[0] in ("a", "button", "option")
        tags = sum(x.tags for x in inside) + len(inside)
        measure[id(node)] = Leaf("", chars, tags, chars if whole else sum(x.link_chars for x in inside), 1 + tags if whole else sum(x.link_tags for x in inside))
        nodes.append((node, measure[id(node)], inside))
    root = measure[id(order[0])]
    for _, x, _ in nodes:
        x.density = composite(x, root)
    best, _, _ = max(nodes, key=lambda n: sum(x.density for x in n[2]))
    parent = {id(x): node for node in order for x in node[1] if isinstance(x, list)}
    threshold, at = measure[id(best)].density, best
    while id(at) in parent and parent[id(at)][0]:
        at = parent[id(at)]
        threshold = min(threshold, measure[id(at)].density)
    inline = frozenset("a abbr b br cite code em font i mark q s small span strong sub sup u h1 h2 h3 h4 h5 h6 td th tr tbody li".split())
    parts: list[str] = []
    todo = [(best, False)]
    while todo:
        node, kept = todo.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        x = measure[id(node)]
        kept = node is best or x.density >= threshold or kept and node[0] in inline and not (x.links and node[0] not in ("a", "span"))
        if node[0] in ("br", "p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6"):
            parts.append("\n")
        for child in reversed(node[1]):
            if kept or isinstance(child, list):
                todo.append((child, kept))
    lines = [" ".join(x.split()) for x in "".join(parts).split("\n")]
    return "\n".join(x for x in lines if x)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _lines(pages: pd.Series) -> pd.Series:
    return pd.Series([furniture_lines(p) if isinstance(p, str) and "\n" in p and not kind(p) else [] for p in pages], dtype=object)


@F.pandas_udf(T.StringType())
def body(pages: pd.Series) -> pd.Series:
    """Each page without its furniture: by its nodes where it is HTML, else by its lines; a text without furniture as it is, null for null."""

    def one(page: str | None) -> str | None:
        if isinstance(page, str) and _BLOCKS.search(page) and (found := dom_body(page)):
            return found
        if not (drop := set(furniture_lines(page))):
            return page if isinstance(page, str) else None
        return "\n".join(x for i, x in enumerate(page.split("\n"), 1) if i not in drop).strip("\n")

    return pd.Series([one(p) for p in pages], dtype=object)


def furniture(pages: DataFrame, key: str = "rec_id", text: str = "output") -> DataFrame:
    """(key, line_no): the lines of each page that aren't part of its body, counted from 1, blank lines counted but never given.

    Residue (see ``residue``) is left aside; null, empty and one-line texts have no such lines. One pass without a shuffle; a
    page of any length is looked at whole; equal rows give equal results.
    """
    found = take(pages, **{key: key, "text": text}).select(key, _lines("text").alias("n"))
    return found.select(key, F.explode(F.col("n").cast("array<long>")).alias("line_no"))
