"""A small landing tree in the shape of the original fixtures (our own content).

Data centre ``idc``, data type ``webcdr``:

* ``alphanet``: version 1 (``;``) and, from 2024-03-10, version 2 (``|``);
* ``gammatel``: version 1 only; ``zetanet``: no descriptor (unknown operator);
* ``CDR_bad_name``: a data file whose name carries no operator.
"""

from __future__ import annotations

import json
import os

from cdrflow.schema import LINE_FIELDS

START_1, START_2 = "2001-02-03 04:05:06", "2024-03-10 00:00:00"
DAY = 1_709_539_200              # 2024-03-04 08:00:00 UTC, under version 1
LATER = DAY + 10 * 86_400        # under version 2

#: Types of the fields that aren't text.
TYPES = {"session_time": "int", "page_sent": "int", "duration": "int"}
FIELDS = [(name, TYPES.get(name, "String"), "") for name in LINE_FIELDS]

def descriptor(start: str, delimiter: str, operator: str = "demo_operator") -> str:
    body = {"fields": [{"name": n, "type": t, "format": f} for n, t, f in FIELDS]}
    return (f"format_start_date_time={start}\nplatform_name=webcdr\nplatform_format_version=2\n"
            f"operator={operator}\ndelimiter={delimiter}\nfields={json.dumps(body)}\n")


# Subscribers: two with an imsi, one without on text messages too, and two of gammatel.
ANNA, BERT, CARL, DORA = "+49151000201", "+49151000202", "+49151000203", "+49151000904"
EMIL, FAYE = "+49160000305", "+49160000306"
IMSI = {who: "262019" + who[-9:] for who in (ANNA, BERT, CARL, EMIL, FAYE)}
MENU = "file:/var/menu"


def record(who, time, service="", bearer="U2", pages="0", seconds="0", urls="", extra=None, language="de", sep=";"):
    fields = [who, IMSI.get(who, ""), "", "", language, str(time), service, bearer, pages, seconds, "4917000", "", urls]
    return sep.join(fields if extra is None else [*fields, extra])


ALPHANET_1 = [
    record(CARL, DAY + 7, "*55#", pages="1", seconds="31", urls=f"*55#={MENU}/weather.xml#today"),
    record(ANNA, DAY + 61, "*55#", pages="4", seconds="75",
           urls=f"*55#={MENU}/weather.xml,a={MENU}/weather.xml#week,1={MENU}/weather.xml#today,2={MENU}/balance.xml"),
    # a page that is the start of two others
    record(BERT, DAY + 150, "*77#", pages="3", seconds="48",
           urls=f"*77#={MENU}/news.xml,1={MENU}/news.xml#p1,2={MENU}/news.xml#p12"),
    record(DORA, DAY + 200, bearer="sms", urls="", extra="alert#daily", language=""),
    # the same page twice, with different queries
    record(DORA, DAY + 333, pages="2", seconds="9", urls="#1=http://example.com/a?x=1,2=http://example.com/a?x=2", language=""),
    # no page, no number of pages, no extra
    record(DORA, DAY + 402, pages="x", seconds="5", language=""),
    # still written in the old layout after the new one's start
    record(ANNA, LATER + 900, "*55#", pages="1", seconds="12", urls=f"*55#={MENU}/balance.xml"),
]
ALPHANET_2 = [
    record(CARL, LATER, "*56#", pages="2", seconds="44", urls=f"*56#={MENU}/weather.xml#today,1=https://example.org/p+q/x", sep="|"),
    record(CARL, LATER + 55, "*56#", pages="1", seconds="17", urls=f"*56#={MENU}/weather.xml#today", sep="|"),
]
ELEVEN_PAGES = [f"file:/var/list/{i}.xml" for i in range(1, 12)]
GAMMATEL = [
    record(EMIL, DAY + 20, "*56#", pages="2", seconds="66", urls=f"*56#={MENU}/help.xml,1={MENU}/terms.xml"),
    record(FAYE, DAY + 95, "*56#", pages="11", seconds="240", urls="*56#=" + ",".join(f"{i}={u}" for i, u in enumerate(ELEVEN_PAGES, 1))),
]
UNKNOWN = [record("+49170000407", DAY + i, "*56#", seconds="1") for i in (1, 2)]
BAD_NAME = [record("+49170000408", DAY + 3, "*56#", seconds="1")]

STANDARD_ROWS = len(ALPHANET_1) + len(ALPHANET_2) + len(GAMMATEL)
REJECTED = {"unknown_operator": 2, "no_operator": 2}
USERS = 6
PAGES = 9 + 2 + 11


def write(path: str, lines: list[str], newline: str = "\n", trailing_blank: bool = False) -> None:
    with open(path, "w", newline="") as fh:
        fh.write(newline.join(lines) + newline)
        if trailing_blank:
            fh.write(newline)


def build_landing(root: str, dc: str = "idc", datatype: str = "webcdr") -> str:
    d = os.path.join(root, dc, datatype)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
        fh.write(descriptor(START_1, ";"))
    with open(os.path.join(d, "data_format-x-alphanet-2.properties"), "w") as fh:
        fh.write(descriptor(START_2, "|"))
    with open(os.path.join(d, "data_format-x-gammatel-1.properties"), "w") as fh:
        fh.write(descriptor(START_1, ";"))
    write(os.path.join(d, "CDR_alphanet_20240304_080000_h1_0001"), ALPHANET_1, "\r\n", True)
    write(os.path.join(d, "CDR_alphanet_20240314_080000_h1_0002"), ALPHANET_2)
    write(os.path.join(d, "CDR_gammatel_20240304_080000_h2_0001"), GAMMATEL)
    write(os.path.join(d, "CDR_zetanet_20240304_080000_h2_0002"), UNKNOWN)
    write(os.path.join(d, "CDR_bad_name"), BAD_NAME)
    write(os.path.join(d, "notes.txt"), ["no record, but no descriptor either"])
    return root
