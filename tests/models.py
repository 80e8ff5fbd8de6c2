"""Row-by-row models of the ordered rules, written from their description.

They hold one sheet in a list and exist only to check the Spark operators.
"""

import random

WORDS = ["alpha", "Beta", "gamma delta", "7", "Table 3", "note:", "* star", "x.pdf", "Effective now", "Total", "12"]


def cells_of(row):
    return [v for v in row if v is not None]


def random_sheet(rng, width, n_rows, indent=True):
    sheet = []
    for _ in range(n_rows):
        kind = rng.random()
        fill = 0.0 if kind < 0.12 else 0.2 if kind < 0.4 else 0.6 if kind < 0.6 else 0.95
        row = [rng.choice(WORDS) if rng.random() < fill else None for _ in range(width)]
        if kind >= 0.12 and kind < 0.25:
            row = [rng.choice(WORDS)] + [None] * (width - 1)
        if indent and row[0] is not None:
            row[0] = " " * rng.randrange(4) + row[0]
        sheet.append(row)
    return sheet


def random_sheets(seed, count, width=6, longest=40, indent=True):
    rng = random.Random(seed)
    return {i: random_sheet(rng, rng.randrange(2, width + 1), rng.randrange(1, longest), indent) for i in range(count)}


def indent_paths(sheet):
    """Stack of (level, label); deeper or equal entries leave before a label enters."""
    stack, out = [], []
    for row in sheet:
        row = list(row)
        if row[0] is not None:
            level = len(row[0]) - len(row[0].lstrip())
            while stack and stack[-1][0] >= level:
                stack.pop()
            stack.append((level, row[0].strip()))
            row[0] = " ".join(label for _, label in stack)
        out.append(row)
    return out


def tables_down(sheet):
    """Table number of every non-blank row."""
    out, header, pending, number = [], False, 0, -1
    for i, row in enumerate(sheet):
        filled = cells_of(row)
        below = sheet[i + 1] if i + 1 < len(sheet) else None
        n_below = len(cells_of(below)) if below else 0
        if not filled:
            if below and pending > 10 and n_below > 1 and below.count(None) > 2:
                if header:
                    pending = 0
                header = True
            continue
        if filled[0].strip().startswith("Table"):
            pending, header = 0, True
        lone_off = len(filled) == 1 and row[0] is None
        thin = len(row) // 2 > len(filled) and len(filled) != 1
        if thin or lone_off:
            texts = sum(v.strip()[0].isalpha() for v in filled)
            heading = n_below > 1 if len(filled) == 1 else texts > 1
            if heading and header and pending > 10:
                pending, header = 0, False
        if pending == 0:
            number += 1
            if len(filled) > 1:
                header = True
        pending += 1
        out.append((i, number))
    return out


def uspto_roles(sheet):
    """Role of every row: blank, body, title, footer, label or other."""
    titles, bodies, noted, out = 0, 0, False, []
    for row in sheet:
        filled = cells_of(row)
        if not filled:
            out.append("blank")
        elif len(filled) > 1 or row[0] is None:
            bodies += 1
            out.append("body")
        elif bodies == 0:
            titles += 1
            out.append("title")
        elif titles > 1 and bodies > 1 and (not filled[0][0].isalpha() or filled[0].startswith(("changed", "Effective"))):
            noted = True
            out.append("footer")
        else:
            out.append("other" if noted else "label")
    return out


def uspto_carried(sheet):
    """Body rows with the running label before their first cell."""
    label, out = "", []
    for i, (row, role) in enumerate(zip(sheet, uspto_roles(sheet))):
        alone_above = i > 0 and len(cells_of(sheet[i - 1])) == 1
        if role == "blank":
            label = ""
        elif role == "label":
            label = f"{label} {row[0]}" if alone_above else row[0]
        elif role == "body":
            first = row[0] if label == "" else f"{label} {row[0] or ''}"
            out.append((i, [first, *row[1:]]))
    return out


def soi_carried(body):
    """(row number, row, label) with runs of lone rows taken out as labels."""
    rows = [list(r) for r in body]
    label, out, last = None, [], len(rows) - 2
    for i, row in enumerate(rows):
        if len(cells_of(row)) == 1 and i < last:
            text = cells_of(row)[0]
            if len(cells_of(rows[i + 1])) == 1:
                rows[i + 1] = [f"{text} {cells_of(rows[i + 1])[0]}"] + [None] * (len(rows[i + 1]) - 1)
            else:
                label = text
            continue
        out.append((i, row, label))
    return out


def special_kept(sheet):
    """Rows of the sheets whose lone cells stay."""
    kept, text = [], None
    for i, (row, role) in enumerate(zip(sheet, uspto_roles(sheet))):
        row = list(row)
        if role == "blank":
            text = None
        if role == "label":
            alone_above = i > 0 and len(cells_of(sheet[i - 1])) == 1
            if alone_above and not row[0].startswith(" ") and text is not None:
                text = f"{text} {row[0].strip()}"
                row[0] = text
            else:
                text = row[0]
        if role in ("body", "label"):
            kept.append((i, row))
    out, moved = [], False
    for i, row in kept:
        lone = len(cells_of(row)) == 1
        if lone and row[0] == "Patent Matters":
            moved = True
            continue
        if moved:
            row[0] = f"Patent Matters {row[0] or ''}" if row[0] else "Patent Matters"
        moved = False
        if row[0] is None or (lone and (row[0].endswith(":") or not row[0].startswith(" "))):
            continue
        out.append((i, row))
    return out


def spans(rows):
    """Rows of (text, rowspan): a span puts empty cells below, at its own index."""
    out = [[text for text, _ in row] for row in rows]
    for i, row in enumerate(rows):
        for j, (_, span) in enumerate(row):
            for below in out[i + 1 : i + span]:
                below[j:j] = [""]
    return out


def html_roles(sheet):
    first = next((i for i, r in enumerate(sheet) if len(cells_of(r)) > 1 or (cells_of(r) and r[0] is None)), None)
    lone = [i for i, r in enumerate(sheet) if len(cells_of(r)) == 1 and r[0] is not None]
    out = []
    for i, row in enumerate(sheet):
        if not cells_of(row):
            out.append("blank")
        elif i not in lone:
            out.append("body")
        elif first is None or i < first:
            out.append("title")
        else:
            out.append("footer" if i == lone[-1] else "other")
    return out
