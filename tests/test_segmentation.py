"""Segments of made volumes against loops over their lines and characters."""

import hashlib
import random
import re
import unicodedata

import __spark_entry__ as entry
from quillgraph.operators import segmentation

PAGE = re.compile(r"<!-- page (\d+) -->")
PROVINCES = (
    "ONTARIO|QUEBEC|NOVA SCOTIA|NEW BRUNSWICK|PRINCE EDWARD ISLAND|MANITOBA|BRITISH COLUMBIA|SASKATCHEWAN|ALBERTA|NORTH-?WEST TERRITORIES|"
    "NORTHWEST TERRITORIES|YUKON|MANITOBA AND (?:THE )?NORTH-?WEST(?: TERRITORIES)?"
)
PROVINCE = re.compile(rf"^(?:PROVINCE OF )?({PROVINCES})[ .,]*$", re.M)
SUBHEAD = re.compile(rf"^({PROVINCES})\.?( ?[-–—] ?(Continued|Concluded)\.?)?\s*$", re.M)
SIR = re.compile(r"^\s*SIR\s?, ?[-—]", re.M)
CAPTION = re.compile(
    r"^(TABULAR STATEMENT No\. ?\d+[A-Za-z]?\.?|RETURN,? [A-Z],? ?(?:\(?\d+\)?)?\.?|STATEMENT [A-Z0-9][A-Za-z0-9 ,.()'-]{0,70}|SCHOOL STATEMENT[A-Za-z0-9 ,.()'-]{0,60}|APPENDIX[A-Za-z0-9 ,.()'-]{0,60})\s*$",
    re.M,
)
CONTENTS = re.compile(r"^(INDEX|CONTENTS)\.?\s*$", re.M)
HEADING = re.compile(r"^[A-Z][A-Z0-9 ,.&:;()'’-]{3,70}$")
UNIT = re.compile(r"\b(AGENCY|AGENCIES|SUPERINTENDENCY|INSPECTORATE|COMMISSIONER|SURVEY|SCHOOL|OFFICE|RESERVE|BAND)\b")
CLOSING = re.compile(r"(obedient|humble)\s+servant|I have the hono[u]?r to be|I have, ?&|I am, ?(Sir|&)|Yours (very )?(truly|sincerely|respectfully)", re.I)


def unit(line):
    letters = [c for c in line if c.isalpha()]
    return sum(c.isupper() for c in letters) > 0.7 * max(1, len(letters)) and bool(UNIT.search(line.upper()))


def letter(lines, at):
    """Where the letter begins whose salutation, or the blank lines above it, begin at a line, and its heading."""
    start, heading = at, None
    for i in range(at - 1, max(-1, at - 15), -1):
        line = lines[i].strip()
        if line and not PAGE.match(line):
            if len(line) > 110:
                break
            if unit(line):
                heading = line.rstrip(".,")
            elif len(line) > 90:
                break
        start = i
    formula = [i for i in range(start, at) if CLOSING.search(lines[i])]
    if formula:
        start, heading = formula[-1] + 1, None
        while start < at and lines[start].strip() and not PAGE.match(lines[start].strip()) and not unit(lines[start].strip()):
            start += 1
        heading = next((x.rstrip(".,") for x in map(str.strip, lines[start:at]) if x and unit(x)), None)
    if heading is None:
        heading = next((x.rstrip(".,") for x in map(str.strip, lines[start : at + 1]) if x and not PAGE.match(x)), None)
    return start, heading or "letter"


def page_at(pages, at):
    return next((n for p, n in reversed(pages) if p <= at), pages[0][1] if pages else 1)


def parts(seg, body, pages):
    s, e, kind, heading = seg
    if e - s <= 150_000:
        return [seg]
    cuts = [s]
    for c in [m.start() + s for m in SUBHEAD.finditer(body[s:e]) if m.start() > 500] + [e]:
        while page_at(pages, c) - page_at(pages, cuts[-1]) > 60:
            far = [p for p, n in pages if cuts[-1] < p < e and n - page_at(pages, cuts[-1]) >= 60]
            if not far or far[0] >= c:
                break
            cuts.append(far[0])
        if c - cuts[-1] > 500 and c < e:
            cuts.append(c)
    if len(cuts) == 1:
        return [seg]
    out = []
    for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], e], strict=True)):
        m = SUBHEAD.match(body[a : a + 90])
        out.append((a, b, kind, f"{heading} — {m.group(1).title()}" if m else heading if i == 0 else f"{heading} (cont.)"))
    return out


def plain(raw):
    m = re.match(r"^---\n.*?\n---\n", raw, re.S)
    said = m and re.search(r'^document_type:\s*"?([\w]+)"?', m.group(0), re.M)
    doc_type, body = said.group(1) if said else "annual_report", raw[m.end() :] if m else raw
    lines = body.split("\n")
    starts = [0]
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    pages = [(m.start(), int(m.group(1))) for m in PAGE.finditer(body)]
    sirs = [body.count("\n", 0, m.start()) for m in SIR.finditer(body)]
    letters = len(sirs) >= 10 and doc_type == "annual_report"
    bounds = [(starts[i], "agency_letter", h) for i, h in (letter(lines, at) for at in sirs)] if letters else []
    for m in CAPTION.finditer(body):
        bounds.append((m.start(), "tabular_statement" if "STATEMENT" in m.group(1) else "return" if m.group(1).startswith("RETURN") else "appendix", m.group(1).strip().rstrip(".")))
    for i, line in enumerate([] if letters else lines):
        s, following = line.strip(), lines[i + 1].strip() if i + 1 < len(lines) else ""
        if HEADING.match(s) and not CAPTION.match(s) and not PROVINCE.match(s) and not re.match(r"^PART [IVX]+\.?\s*$", s) and not s.startswith("TABLE") and 2 <= len(s.split()) <= 10:
            if not (following and HEADING.match(following)) and (i == 0 or not lines[i - 1].strip()):
                bounds.append((starts[i], "thematic_section", s.rstrip(".,")))
    first = {}
    for at, kind, heading in sorted(bounds):
        first.setdefault(at, (kind, heading))
    fixed = {}
    pres = re.search(r"^To .{0,120}(Excellency|Royal Highness)", body, re.M)
    cont = CONTENTS.search(body, pres.end() if pres else 0)
    if pres:
        fixed = {0: ("title_page", "Title page")} | {pres.start(): ("presentation_letter", "Presentation letter")}
    if cont:
        fixed[cont.start()] = ("contents", "Contents")
    if cont and first and min(first) > cont.end():
        head = next((starts[i] for i, line in enumerate(lines) if cont.start() < starts[i] < min(first) and len(line.strip()) > 150), None)
        fixed |= {head: ("head_report", "Report of the Department")} if head is not None else {}
    places = sorted((fixed | first).items())
    segs = [(at, places[i + 1][0] if i + 1 < len(places) else len(body), *x) for i, (at, x) in enumerate(places)]
    out, used = [], set()
    for s, e, kind, heading in [p for seg in segs if seg[1] - seg[0] >= 40 for p in parts(seg, body, pages)]:
        province = next((PROVINCE.match(x.strip()).group(1) for x, at in reversed(list(zip(lines, starts, strict=False))) if at <= s and PROVINCE.match(x.strip())), None)
        opening = PROVINCE.search(body[s:e][:1200])
        slug = re.sub(r"[^A-Za-z0-9]+", "-", unicodedata.normalize("NFKD", heading).encode("ascii", "ignore").decode()).strip("-").lower()[:30].rstrip("-") or "section"
        name, k = f"p{page_at(pages, s):04d}-{slug}", 2
        while name in used:
            name, k = f"p{page_at(pages, s):04d}-{slug}-{k}", k + 1
        used.add(name)
        out.append((doc_type, name, len(out), kind, heading, opening.group(1) if opening else province, page_at(pages, s), page_at(pages, max(s, e - 1)), s, e, hashlib.sha1(body[s:e].encode()).hexdigest()[:12]))
    return out


def made(rng, letters, n):
    """Lines of every role in a random order, and page marks that mostly go up."""
    page, out = rng.choice([1, 7, 12345]), []
    prose = lambda low, high: ("It was a year of good crops, " * 9)[: rng.randrange(low, high)]
    kinds = [
        lambda: "", lambda: rng.choice(["", "  ", "\t"]), lambda: f"<!-- page {page} -->", lambda: f"the end <!-- page {page} --> and <!-- page {page + 1} --> on", lambda: rng.choice(["ONTARIO.", "PROVINCE OF QUEBEC", "  YUKON ,", "MANITOBA AND THE NORTH-WEST TERRITORIES", "ONTARIO\r"]),
        lambda: rng.choice(["OAK AGENCY,", "SIX NATIONS BAND", "SIX NATIONS BAND 2", "SIX NATIONS BAND-2.", "ÉCOLE SCHOOL, 3", "Oak Agency", " THE PIAPOT’S RESERVE "]), lambda: rng.choice(["A. NAME,", "Agent.", "Ottawa, 1 July 1890.", ".,", "THE CROP OF THE YEAR", "PART IV.", "TABLE OF FISH"]),
        lambda: prose(1, 60), lambda: prose(85, 115), lambda: prose(140, 200), lambda: rng.choice(["I am, Sir,", "Your obedient servant", "I have the honour to be, " + prose(60, 100), "Yours truly, OAK AGENCY"]),
        lambda: rng.choice(["RETURN A (1).", "RETURN, B", "STATEMENT A Showing Lands", "  STATEMENT 3", "APPENDIX B.", "TABULAR STATEMENT No. 2.", "SCHOOL STATEMENT, 1902. "]), lambda: rng.choice(["CONTENTS", "INDEX. ", "To His Excellency the Governor", "To the  Royal Highness"]),
    ]
    for _ in range(n):
        page += rng.choice([0, 0, 0, 1, 2, -1 if rng.random() < 0.1 else 0])
        if letters and rng.random() < 0.12:
            out.append(rng.choice(["SIR,—", " SIR, - ", "SIR,-", "\n\nSIR,—", "SIR\n,—"]) + prose(0, 200))
        out.append(rng.choice(kinds)())
    return "\n".join(out)


def test_segments_as_by_loops(spark):
    rng = random.Random(3)
    opening = "ANNUAL REPORT\n\n<!-- page 3 -->\nTo His Excellency the Governor\nMay it please\n\nCONTENTS.\n\nOak 1\n" + "long prose " * 20 + "\nmore\n\n"
    texts = [made(rng, i % 2 == 0, rng.choice([3, 40, 160])) for i in range(24)]
    long = max(texts, key=lambda t: t.count("SIR"))
    texts += [opening + t for t in texts[:6]] + ["---\ndocument_type: \"schedule\"\ntitle: x\n---\n" + long, "---\nx: y\n---\n" + opening + long, "---\nno end", "", None, "CONTENTS\n" + "long prose " * 30 + "\n\nTHE ISLANDS\n" + "y " * 40]
    got = segmentation.segmented(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id", "char_start").collect()
    kinds, types = {r.kind for r in got}, {r.doc_type for r in got}
    assert kinds == {"title_page", "presentation_letter", "contents", "head_report", "agency_letter", "tabular_statement", "return", "appendix", "thematic_section"} and types == {"annual_report", "schedule"}
    for i, text in enumerate(texts):
        assert [tuple(r[1:]) for r in got if r.doc_id == i] == ([] if text is None else plain(text)), i
    assert any(re.search("-2-[0-9]$", r.segment_id) for r in got)


def test_parts_of_large_segments_as_by_loops(spark):
    rng = random.Random(8)
    texts = []
    for wide in (1, 2, 25, 70):
        lines, page = ["RETURN A (1)."], 1
        while sum(map(len, lines)) < 330_000:
            page += rng.choice([wide, wide, 1, 0, -wide if rng.random() < 0.05 else 0])
            lines += [rng.choice([f"<!-- page {page} -->", f"12 <!-- page {page} --> 13"]), *(rng.choice([[], [], [], ["ONTARIO."], ["ALBERTA - Continued.", "", "YUKON"], ["NORTH-WEST TERRITORIES"], ["PROVINCE OF QUEBEC"]]) if rng.random() < 0.3 else []), "word " * rng.choice([20, 80, 400])]
            lines += ["", "THE LONG SECTION", ""] if rng.random() < 0.003 else []
        texts.append("\n".join(lines))
    texts += ["SIR,—\n" * 9 + "long " * 30 + "\nONTARIO\nSIR,—\n" + "x" * 160_000 + "\nYUKON\n" + "y" * 400, "RETURN B.\n" + "z" * 200_000]
    got = segmentation.segmented(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id", "char_start").collect()
    for i, text in enumerate(texts):
        assert [tuple(r[1:]) for r in got if r.doc_id == i] == plain(text), i
    assert any(r.heading.endswith("(cont.)") for r in got) and any(r.heading.endswith("North-West Territories") for r in got) and any(r.heading == "ONTARIO — Ontario" for r in got)


def test_volumes_of_the_query_take_every_step(spark, small):
    got = entry.queries()["volume_segments"](spark, small).collect()
    assert {r.kind for r in got} == {"title_page", "presentation_letter", "contents", "head_report", "agency_letter", "return", "thematic_section"}
    assert {r.doc_type for r in got} == {"annual_report", "schedule"} and {r.page_end - r.page_start for r in got} > {0}
