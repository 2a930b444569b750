"""Small look-alike source files written to a temp folder (no data is kept
in the repository)."""

from __future__ import annotations

import os

ORIG_HEADER = ('YRQTR,New Originations ($Billions),Number of New Accounts (Millions),'
               'Original Credit Limit (50th percentile),Average Original Purchase APR: General Purpose')
BAL_HEADER = ('"YRQTR","Total Balances ($Billions)","Number of Accounts (Millions)",'
              '"Percentage of Accounts with Credit Line Decrease"')
FOOTERS = ["Source: Example survey data", "Website: https://example.org/data", "Email: data@example.org"]


def write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def orig_csv(path: str, quarters, preamble: bool = False, bom: bool = False) -> str:
    lines = ([FOOTERS[0]] if preamble else []) + [ORIG_HEADER]
    for q, amt, cnt in quarters:
        money = f'"${amt}"' if "," in amt else f"${amt}"
        lines.append(f'{q},{money},{cnt},"$2,070.51",19.34 %')
    lines += [""] + FOOTERS
    return write(path, ("\ufeff" if bom else "") + "\n".join(lines) + "\n")


def bal_csv(path: str, quarters) -> str:
    lines = [BAL_HEADER]
    for q, amt in quarters:
        lines.append(f'"{q}","${amt}","516.72","null"')
    lines += [""] + FOOTERS
    return write(path, "\n".join(lines) + "\n")


def series_csv(path: str, points, value_name: str = "PRIME") -> str:
    lines = [f"observation_date,{value_name}"] + [f"{d},{v}" for d, v in points]
    return write(path, "\n".join(lines) + "\n")


def lending_xml(path: str, records, broken: bool = False) -> str:
    body = []
    for fields in records:
        inner = "".join(
            f'<field name="{k}" />' if v is None else f'<field name="{k}">{v}</field>' for k, v in fields)
        body.append(f"  <record>{inner}</record>")
    text = '<?xml version="1.0" encoding="utf-8"?>\n<Root>\n <data>\n' + "\n".join(body) + "\n </data>\n</Root>\n"
    if broken:
        text = text[: len(text) // 2]
    return write(path, text)
