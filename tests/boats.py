"""A marina's berth register in four formats: the layout and all rows are made up for these tests."""

import json

FIELDS = ["code", "owner", "hull", "phone", "fee", "launched", "afloat", "skills", "address", "emergency_contact", "notes"]
LIMITS = {"code": (4, 8), "owner": (2, 40), "hull": (3, 9), "fee": (1, 9), "launched": (4, 4)}
STARTS = {"code": 1, "owner": 10, "hull": 33, "phone": 44, "fee": 60, "launched": 68, "afloat": 74, "skills": 81, "address": 110, "emergency_contact": 190, "notes": 290}
ENDS = [8, 30, 42, 58, 66, 72, 79, 108, 188, 288, 310]


def descriptor(fmt, encrypt=("phone", "fee"), optional=("notes",), limits=True, **extra):
    fields = {}
    for name in FIELDS:
        rule = {"required": name not in optional}
        if limits and name in LIMITS:
            rule |= {"min_length": 0 if name in optional else LIMITS[name][0], "max_length": LIMITS[name][1]}
        if name in encrypt:
            rule |= {"sensitive": True, "encrypt": True}
        fields[name] = rule
    return json.dumps({"format": fmt, "target_table": "berths", **extra, "fields": fields})


def boat(i, **changes):
    row = {
        "code": f"B-{i:03d}", "owner": f"Ada Quill {i}", "hull": "oak" if i % 2 else "steel", "phone": f"0471 {8800 + i}",
        "fee": 310 * i, "launched": str(1960 + i), "afloat": i % 2 == 0, "skills": ["mast", "keel"],
        "address": {"quay": f"Pier {i}", "town": "Emden"}, "emergency_contact": {"who": "Jo Brand", "phone": f"0491 {100 + i}"},
        "notes": f"slot {i}" + " and a long stay at the outer pier" * 12,
    }
    return row | changes


def text_of(v):
    if isinstance(v, bool):
        return "true" if v else "false"
    return json.dumps(v, separators=(",", ":")) if isinstance(v, (list, dict)) else str(v)


def csv_line(b):
    flat = b | {"skills": ";".join(b["skills"]), "address": '"Pier Emden"', "emergency_contact": "Jo Brand 0491"}
    return ",".join(text_of(flat[f]) for f in FIELDS)


def csv_file():
    """A good row, one of empty cells (one cell short), one without its code, and one with a cell too many."""
    shifted = csv_line(boat(4)).replace("Ada Quill 4", "Quill, Ada 4")
    no_code = csv_line(boat(3, code=""))
    return "\n".join([",".join(FIELDS), csv_line(boat(1)), "," * 9, no_code, shifted])


def json_file():
    return json.dumps([boat(1), boat(2), boat(3, owner="")], indent=2)


def xml_file():
    out = ['\n<?xml version="1.0" encoding="UTF-8"?>', "<boats>"]
    for i in (1, 2, 3):
        out.append("  <boat>")
        out += [f"    <{f}>{text_of(v).replace('&', '&amp;').replace('<', '&lt;')}</{f}>" for f, v in boat(i).items()]
        out.append("  </boat>")
    return "\n".join([*out, "</boats>"]) + "\n"


def fixed_file():
    out = []
    for i in (1, 2, 3):
        line = ""
        for f, end in zip(FIELDS, ENDS):
            line = line.ljust(STARTS[f] - 1) + text_of(boat(i)[f])[: end - STARTS[f] + 1]
        out.append(line)
    return "\n".join(out) + "\n\n"


def fixed_descriptor():
    doc = json.loads(descriptor("FIXEDWIDTH", optional=("owner", "skills", "address", "emergency_contact", "notes"), limits=False))
    doc["columns"] = [{"name": f, "start": STARTS[f], "length": end - STARTS[f] + 1} for f, end in zip(FIELDS, ENDS)]
    doc["fields"]["emergency_contact"] |= {"sensitive": True, "encrypt_nested_phone": True}
    return "\ufeff" + json.dumps(doc)


#: The same register under another header, which begins with the same field.
OTHER_HEADER = "code,skipper,timber,call,rent,year,moored,gear,place,kin,remark"
OTHER_CSV = "\n".join([OTHER_HEADER, csv_line(boat(11)), "," * 10, csv_line(boat(12)), csv_line(boat(13))]) + "\n"
GAPS_CSV = "\n".join([
    OTHER_HEADER, csv_line(boat(21)), csv_line(boat(22, hull="")), "," * 10, csv_line(boat(23)), csv_line(boat(24, owner="")),
])
