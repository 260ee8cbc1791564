"""Which lines of a page are furniture: the element rules behind the site-template operator.

A page in markdown is read as a shallow element tree: a *section label* (``## Most read``,
``### Comments``, ``Menu`` ...) owns the list or comment lines below it; every other line is a
leaf. A leaf or subtree is furniture when

* its template hash recurs over the pages of its host (counted by Spark, see
  :mod:`quillgrid.llm.boilerplate`), or
* it is an element whose text differs on every page but whose *form* belongs to the page: byline,
  date line, breadcrumb, link bar, read-next link, advertisement, share or newsletter prompt,
  comment, author note, tag line, copyright or legal line.

A message that stands in place of a story (see :mod:`quillgrid.llm.residue`) is story and never
furniture, however often it recurs.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import xxhash

from quillgrid.llm.residue import MESSAGE_KEYS, STEMS, is_filler, is_message

LIST_ITEM = re.compile(r"^(?:[*\-+•]|\d{1,2}[.)])\s+\S")

_MONTH = (
    r"(?:jan(?:uary|uar|vier)?|feb(?:ruary|ruar)?|f[ée]vr(?:ier)?|mar(?:ch|s|zo)?|m[äa]rz|apr(?:il)?|avr(?:il)?|may|mai|mayo"
    r"|june?|juni|juin|junio|july?|juli|juil(?:let)?|julio|aug(?:ust)?|ao[ûu]t|agosto|sept?(?:ember|embre|iembre)?"
    r"|oct(?:ober|obre|ubre)?|okt(?:ober)?|nov(?:ember|embre|iembre)?|dec(?:ember)?|d[ée]c(?:embre)?|dez(?:ember)?|dic(?:iembre)?"
    r"|enero|ene|febrero|abril|abr)"
)
_CLOCK = r"\d{1,2}[:.h]\d{2}(?::\d{2})?\s*(?:[ap]\.?m\.?|uhr)?(?:\s*[a-z]{2,4})?"
_DATE = (
    rf"(?:(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,?\s+)?"
    rf"(?:{_MONTH}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?(?:,?\s+\d{{4}})?"
    rf"|\d{{1,2}}\.?\s+(?:de\s+)?{_MONTH}\.?(?:\s+(?:de\s+)?\d{{4}})?"
    rf"|{_MONTH}\.?\s+\d{{4}}"
    rf"|\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{2,4}}))"
)
_AGO = r"(?:\d+\s*(?:h|m|d|min|mins|minutes?|hours?|days?|weeks?|std|stunden)\s+ago|vor \d+ \w+|il y a \d+ \w+|hace \d+ \w+)"
_ROLE = r"(?:staff|senior|chief|contributing|special|guest|deputy|associate)?\s*(?:staff\s+)?(?:writer|reporter|correspondent|editor|contributor|columnist|journalist)"
_REL = r"\[[^\]]*\]\((?:/|#|mailto:|\?)[^)]*\)"

#: Labels that own the list items below them.
LABEL = re.compile(
    r"^(?:more stories|more (?:from|on|in|news)\b.{0,40}|trending(?: now| stories)?|most (?:read|popular|viewed|shared)|popular (?:now|stories)"
    r"|you may (?:also )?(?:like|enjoy)|you might also like|related(?: stories| articles| posts| content| reading| news)?|recommended(?: for you| reading| stories)?"
    r"|latest(?: news| stories| headlines)?|further reading|read (?:more|next|also)|keep reading|what to read next|up next|also on .{1,40}|in other news|editors?['’]? picks?"
    r"|meistgelesen|mehr zum thema|das könnte sie auch interessieren|weitere (?:artikel|beiträge|meldungen)|à lire aussi|les plus lus|articles liés|sur le même sujet"
    r"|lo más leído|más noticias|también le puede interesar|artículos relacionados|menu|menü|navigation|sections|sitemap|topics)\s*:?$"
)
COMMENT_LABEL = re.compile(
    r"^(?:(?:reader |user |\d+ )?comments?(?: \(\d+\))?(?: on this (?:page|story|article))?|join the (?:discussion|conversation)|leave a (?:comment|reply)"
    r"|discussion|(?:leser)?kommentare|commentaires|comentarios)\s*:?$"
)
COMMENT = re.compile(rf"^\W*[\w.\-]{{2,40}} (?:wrote|says|said|commented|posted|replied|schrieb|a écrit|escribió),? (?:{_AGO}|on {_DATE}|at {_CLOCK}|yesterday)\b.*|^.{{0,300}}\breply$")

_FORMS = [
    # dates, reading times
    rf"(?:(?:published|posted|updated|last updated|first published|veröffentlicht|aktualisiert|stand|publié le|mis à jour|publicado|actualizado)(?: on| am| el| le)?:?\s*)?(?:{_DATE}(?:,?\s*(?:at\s+|um\s+|à\s+|[-|·]\s*)?{_CLOCK})?|{_AGO})(?:\s*[|·\-]\s*.{{0,40}})?",
    r"(?:about |ca\. )?\d+[\s-]*(?:min(?:ute)?s?\.?)[\s-]*(?:read|reading time|lesezeit|de lecture|de lectura)?",
    r"(?:reading time|read time|lesezeit|temps de lecture|tiempo de lectura)\s*:?\s*\d+.{0,20}",
    # bylines
    rf"(?:by|von|par|por)\s+[^,.;:|]{{3,60}}(?:,| \||/| -| –)\s*{_ROLE}\b.{{0,60}}",
    r"(?:words|text|story|reporting|photos?|photography|edited|translation|video)(?: by)?\s*:\s*[^.]{3,60}\s/\s.{2,60}",
    r"\*+[^*]{3,60} (?:reports?|writes|berichtet|reporting) (?:for|from|für|pour|para) [^*]{2,60}\*+",
    r"(?:written|reported|edited|posted|reviewed|compiled|produced) by \*{0,2}[^*,.]{3,60}\*{0,2}(?:,.{0,60})?",
    rf"[^|.]{{3,60}}\s[|·]\s*{_ROLE}",
    r".{3,60} (?:has covered|covers|has reported on|has written about|writes about|joined) .{3,120} (?:for|at) .{2,60}(?: since .{2,20}|\.)",
    r"(?:follow|contact|email|reach) (?:the author|[a-z'’\- ]{3,50}) (?:on|at) (?:twitter|x|linkedin|mastodon|bluesky|.{0,40}@).{0,60}",
    r"(?:about the author|disclosure|correction policy)\b.{0,200}",
    # navigation
    r"(?:home|homepage|start|startseite|inicio|accueil|you are here:?.{0,20})\s*(?:>|/|»|›|→|\\|::)\s*.{1,160}",
    rf"(?:{_REL}[\s|·•/,*>-]*){{1,30}}",
    r"(?:menu|menü|home|log ?in|sign ?in|sign ?up|register|subscribe|search|newsletters?|about us|contact(?: us)?|jobs|rss|toggle navigation|skip to (?:the )?(?:main )?(?:content|story|article))",
    r"(?:[^|]{1,40}\|\s*){2,20}(?:about us|jobs|contact(?: us)?|imprint|log ?in|newsletter)\b.{0,80}",
    # read next
    rf"(?:related|see also|read (?:next|more|also)|more|also|don['’]t miss|recommended|background|lesen sie auch|mehr dazu|à lire(?: aussi)?|lea también|ver también)\s*[:\-–>]*\s*{_REL}\.?",
    # advertisement, events
    r"(?:advertisement|advert|anzeige|publicité|publicidad|sponsored|promoted|paid content)",
    r"(?:<!--|&lt;!--)\s*(?:ad|ads|advert|banner|slot|promo|sponsor).{0,120}",
    r"\[?(?:sponsored|promoted|paid content|partner content|advertorial|anzeige)\]?\s*[:\-–|]?\s+.{3,400}",
    r".{0,20}\bstory continues below\b.{0,120}|.{0,40}\barticle continues after\b.{0,120}",
    r"join us (?:in|at|on|for) .{3,200}\b(?:summit|conference|webinar|forum|event|meetup|tickets?|speakers?|register)\b.{0,200}",
    r"(?:editor['’]?s pick|podcast|listen(?: now)?|webinar|event|on demand|white ?paper)\b.{0,20}[-–:|].{3,250}",
    r".{3,300}\bbook a demo\b.{0,200}|.{3,300}\bget the white ?paper\b.{0,200}",
    # share, newsletter, paywall
    r"(?:share|tweet|print|email|mail|post|pin|copy link|send) (?:this|it|the) .{0,80}(?:\(\d+\))?|share(?:s|d)?(?: \(?\d+\)?)?",
    r"\d+\s+(?:shares?|comments?|likes?|reactions?)\b.{0,60}",
    r"(?:post it|mail it|tweet|share|print|copy link|facebook|linkedin|x|whatsapp)(?:\s*[|·/]\s*.{2,40}){1,8}",
    rf"(?:pass it on|share|spread the word|teilen|partager|compartir)\s*:\s*(?:{_REL}|[\w ]+)(?:[\s|·,]*(?:{_REL}|[\w ]+)){{0,8}}",
    r"liked this\?.{0,160}|enjoyed? this (?:story|article)\?.{0,160}",
    r".{0,80}\b(?:teilen oder drucken|partager cet article|compartir este artículo)\b.{0,40}",
    r"(?:get|receive|sign up for|subscribe to|don['’]t miss) .{0,100}\b(?:newsletter|briefing|inbox|alerts?|digest)\b.{0,160}",
    r".{0,80}\b(?:enter your email|in your inbox|in ihr postfach|dans votre boîte|en su correo)\b.{0,80}",
    r".{0,60}\bnewsletter\b",
    r"(?:readers|members|subscribers|visitors) of .{2,80} (?:get|have|receive) .{2,40} (?:free|stories|articles).{0,160}|.{0,120}\bsubscribe for (?:full|unlimited) access\b.{0,80}",
    # cookies, privacy
    r".{0,120}\b(?:uses?|stores?|keeps?|sets?|verwendet|utilise|usa|dépose|set|use|using) .{0,60}(?:cookies?|small files on your device|traceurs)\b.{0,240}",
    r".{0,120}\b(?:cookie|privacy|data|consent) (?:policy|notice|settings|preferences|choices)\b.{0,160}",
    r".{0,60}\b(?:you|we|our partners|vendors|partners) .{0,60}\b(?:process|collect|measure) .{0,80}\b(?:device|visits|data)\b.{0,160}",
    r"your privacy at .{2,80}|\[[ x]\] (?:strictly|statistics|functional|marketing|necessary|analytics|preferences|personali).{0,60}|choose which of them you allow:?|save (?:my )?(?:selection|choices|settings|preferences)",
    r"(?:accept|reject|agree|allow|manage|aceptar|accepter|tout accepter|alle annehmen|alle akzeptieren|akzeptieren)(?: all| cookies)?(?:\s*[|·/]\s*.{2,40}){0,6}",
    # tags, legal, footer
    r"(?:filed under|filed in|posted in|topics?|tags?|tagged(?: with| as)?|categories|keywords|schlagwörter|étiquettes|etiquetas|themen)\s*:\s*.{1,200}",
    r"(?:#[\w&\-]+[\s,|]*){2,20}",
    r"(?:\(c\)|©|copyright)\s.{1,240}",
    r".{0,120}\b(?:all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)\b.{0,160}",
    r"no part of this (?:page|site|publication) may be .{3,200}",
    r"(?:terms|imprint|impressum|privacy|legal|datenschutz|mentions légales|aviso legal)(?:[\s|·\-–/]+(?:of use|[\wäöüéèñ &]{2,40})){1,8}",
    r"the (?:information|content|material)s? (?:on|in|of) .{2,120} (?:is|are|does|do) (?:no|not) .{2,200}",
    r".{2,120} accepts? no (?:liability|responsibility) .{2,160}|.{2,80}\bno liability for third.?party content.{0,80}",
    r"a title of the .{2,80}(?:network|group|family).{0,120}|part of the .{2,60} network\.?",
    r".{2,120} receives? .{2,60}(?:sponsorship|funding|support|advertising) from .{3,160}",
]
FORM = re.compile("^(?:" + "|".join(f"(?:{x})" for x in _FORMS) + r")\s*\.?$")

#: A line that is no short one can only have a form if it holds one of these.
KEYS = (
    "](", "cookie", "newsletter", "subscri", "sponsor", "privacy", "inbox", "rights reserved", "rechte vorbehalten", "droits réservés",
    "derechos reservados", "has covered", " covers ", "has reported", "has written", "writes about", " joined ", " reports for", " wrote ", "reply", "continues below",
    "continues after", "©", "(c) ", "copyright", "filed ", "tags:", "tag:", "topics:", "posted in", "categories:", "keywords:", "join us", "editor", "podcast",
    "book a demo", "white paper", "<!--", "share", "advert", "paid content", "liability", "network", "traceurs", "small files", "vendors", "correo", "drucken",
    "partager", "compartir", "staff", "newsroom", "written by", "liked this", "enjoyed this", "no part of", "the information on", "the content on", "imprint", "impressum",
    "listen", "webinar", "home >", "home /", "home »", "home ›", "| ", " · ", "disclosure", "about the author", "email", "correspondent", "reporter", "writer",
    "responsibility", "postfach", "boîte", "data policy", "accept", "[ ]", "your privacy", "event", "follow ", "published", "updated", "summit", "tickets",
)
SHORT = 60

_LEAD = re.compile(r"^(?:>\s*|\*\*|__|\*|_|#{1,6}\s+|[-+•*]\s+|\d{1,2}[.)]\s+)+")
_TAIL = re.compile(r"(?:\*\*|__|\*|_)+$")


def squeeze(line: str) -> str:
    """One blank for each run of blanks, none at the ends."""
    return " ".join(line.split())


_kinds: dict[str, str] = {}


def _label(low: str) -> str:
    """'comments', 'list' or '' for a short line in lower case that may be a section label."""
    kind = _kinds.get(low)
    if kind is None:
        if len(_kinds) > 100_000:
            _kinds.clear()
        bare = _TAIL.sub("", _LEAD.sub("", low)).replace("**", "").strip()
        kind = _kinds[low] = "comments" if COMMENT_LABEL.match(bare) else "list" if LABEL.match(bare) else ""
    return kind


_seen: dict[str, bool] = {}


def is_form(line: str) -> bool:
    """Does a squeezed line have the form of furniture? Lines that recur are judged once."""
    low = line.lower()
    known = _seen.get(low)
    if known is None:
        if len(_seen) > 100_000:
            _seen.clear()
        bare = _TAIL.sub("", _LEAD.sub("", low)).replace("**", "").strip()
        known = _seen[low] = bool(FORM.match(low)) or (bare != low and bool(FORM.match(bare)))
    return known


_FORMED, _TOLD, _LATIN = 1, 2, 4
_machine = None


def _words():
    """One automaton over the word lists; each word carries the lists that it is in."""
    global _machine
    if _machine is None:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for key in {*KEYS, *MESSAGE_KEYS, *STEMS}:
            machine.add_word(key, _FORMED * (key in KEYS) | _TOLD * (key in MESSAGE_KEYS) | _LATIN * (key in STEMS))
        machine.make_automaton()
        _machine = machine
    return _machine


def hits(text: str, starts: list[int]) -> list[int]:
    """For each line of a text, the lists whose words it holds; starts: where the lines begin."""
    found = [0] * len(starts)
    for at, lists in _words().iter(text):
        found[bisect_right(starts, at) - 1] |= lists
    return found


def has_message(lines: list[str]) -> bool:
    """Is one of the lines a message, filler or unrendered value that stands in place of a story?"""
    lines = [squeeze(x) for x in lines]
    lows = [x.lower() for x in lines]
    held = hits("\n".join(lows), [0, *accumulate(len(x) + 1 for x in lows)][:-1])
    return any(x and ((len(x) <= SHORT or held[i] & _TOLD) and is_message(x) or held[i] & _LATIN and is_filler(x)) for i, x in enumerate(lines))


def furniture_flags(lines: list[str]) -> list[bool]:
    """For each line of a page, whether its form is that of furniture. Blank lines are never furniture."""
    return page_flags(lines)[0]


def _stands_for_story(lines: list[str], out: list[bool], held: list[int], i: int, step: int) -> bool:
    """Is the next line with text, in one direction, a message of the story?"""
    i += step
    while 0 <= i < len(lines) and not lines[i]:
        i += step
    return 0 <= i < len(lines) and not out[i] and (len(lines[i]) <= SHORT or bool(held[i] & _TOLD)) and is_message(lines[i])


_RUN = re.compile(r"[0-9]+")
_SITE_LINK = re.compile(r"\[[^\]]*\]\((?:/|#|\?|mailto:)[^)]*\)")
_TAG = re.compile(r"#[\w&-]+")
#: A breadcrumb begins with a short name; a sign of comparison within a sentence is none.
_CRUMBS = re.compile(r"^([^{}()\[\].,;:]{1,24}?) (>|/|»|›|→|::) .*")
_shapes: dict[str, int] = {}


def element_hash(low: str) -> int:
    """The hash of an element, a squeezed line in lower case, without what its slots hold: digits, links within the site, hash tags, the tail of a breadcrumb."""
    known = _shapes.get(low)
    if known is None:
        shape = _RUN.sub("9", low)
        if "](" in shape:
            shape = _SITE_LINK.sub("[]()", shape)
        if "#" in shape:
            shape = _TAG.sub("#", shape)
        if " > " in shape or " / " in shape or " » " in shape or " › " in shape or " → " in shape or " :: " in shape:
            shape = _CRUMBS.sub(r"\1 \2 *", shape)
        known = xxhash.xxh64_intdigest(shape) - (1 << 63)
        if len(low) <= 2 * SHORT:  # those that may recur
            if len(_shapes) > 100_000:
                _shapes.clear()
            _shapes[low] = known
    return known


def element_hashes(lows: list[str]) -> list[int]:
    """For each squeezed line in lower case the hash of its element, 0 for blank lines and titles."""
    return [0 if not low or low.startswith("# ") else element_hash(low) for low in lows]


def is_response(lines: list[str]) -> bool:
    """Is a page without a title a message that was given in place of the page? What recurs on such pages is no template of the site."""
    return not any(x.startswith("# ") for x in lines) and any(x and is_message(x) for x in lines)


def elements(lines: list[str], lows: list[str]) -> tuple[list[int], list[bool]]:
    """For each squeezed line the hash of its element, 0 for blank lines and titles, and whether a list item follows it."""
    hashes = element_hashes(lows)
    owning, below = [False] * len(lines), False
    for i in range(len(lines) - 1, -1, -1):
        if lines[i]:
            owning[i], below = below, lines[i][0] in "*-+•0123456789" and bool(LIST_ITEM.match(lines[i]))
    return hashes, owning


def page_flags(lines: list[str], templates: frozenset[int] = frozenset(), owners: frozenset[int] = frozenset(), forms: bool = True) -> tuple[list[bool], list[str]]:
    """(the furniture flags, the squeezed lines of the story that may be messages).

    templates: the hashes of the elements that recur on the host; owners: those of them that own the
    list below them. A recurring line beside a message that stands in place of a story belongs to it.
    """
    lines = [squeeze(x) for x in lines]
    lows = [x.lower() for x in lines]
    hashes = element_hashes(lows) if templates else [0] * len(lines)
    starts = [0, *accumulate(len(x) + 1 for x in lows)][:-1]
    page = "\n".join(lows)
    held = hits(page, starts)
    out = [False] * len(lines)
    owner, told = None, []
    for i, line in enumerate(lines):
        if not line:
            continue
        low = lows[i]
        short, title = len(low) <= SHORT, low.startswith("# ")
        seen = (hashes[i] in templates) + (hashes[i] in owners)
        item = bool(owner or seen == 2) and bool(LIST_ITEM.match(line))
        if forms and short and not title:
            kind = _label(low)
            if kind:
                owner, out[i] = kind, True
                continue
        if seen == 2 and not item and not is_message(line):
            owner, out[i] = "list", True
            continue
        if owner == "list" and item:
            out[i] = True
            continue
        if forms and held[i] & _FORMED and COMMENT.match(low):
            out[i] = True
            continue
        owner = None
        if title:
            continue
        formed = forms and (short or held[i] & _FORMED) and is_form(line)
        if seen or formed:
            out[i] = not ((short or held[i] & _TOLD) and is_message(line))
            if out[i] and not formed:
                told.append(i)
    for i in told:
        if any(_stands_for_story(lines, out, held, i, step) for step in (-1, 1)):
            out[i] = False
    suspects = [x for i, x in enumerate(lines) if x and not out[i] and (len(x) <= SHORT or held[i] & (_TOLD | _LATIN))]
    return out, suspects
