"""Small deterministic raw CSV fixture with planted quirks (SURVEY Q-ids)."""

import os

HEADER_LISTING = ",".join(f"c{i}" for i in range(1, 23))

# LGA code file: Gamma has a code but no census rows.
LGA_CODE = [("1", "Alpha"), ("2", "beta"), ("3", "Gamma")]
# Suburbs: Beta has 3 suburbs (k = 3), SUB_SHARED sits in two LGAs (Q-14),
# sub_lower is stored lower case (Q-13), Delta has no code (Q-09).
LGA_SUBURB = [("Alpha", "SUB_A1"), ("Beta", "SUB_B1"), ("beta", "SUB_B2"), ("Beta", "SUB_B3"),
              ("Alpha", "SUB_SHARED"), ("Beta", "SUB_SHARED"), ("Alpha", "sub_lower"),
              ("Delta", "SUB_D1")]


def g01_rows():
    rows = []
    for code, base in (("LGA1", 100), ("LGA2", 200)):
        vals = [code, str(base), str(base + 1)] + [str(base + i) for i in range(33)]
        rows.append(vals)
    return rows


def g02_rows():
    return [["LGA1", "38", "2100", "700", "450", "1900", "4.6", "1600", "2.5"],
            ["LGA2", "41", "NULL", "650", "400", "1800", "0.8", "1500", "3.4"]]


def listing_rows(month: int):
    """Twelve listings over six hosts; availability and superhost flags vary."""
    rows = []
    hosts = {  # host -> (name, suburb, superhost)
        1: ('"Smith, J"', "SUB_A1", "t"),
        2: ("Lee", "sub_lower", "f"),       # suburb never resolves -> NULL host_lga
        3: ("Ng", "SUB_SHARED", "t" if month >= 3 else "f"),  # flag changes (Q-07)
        4: ("Roy", "SUB_B2", "f"),
        5: ("Kim", "\\N", "t"),             # NULL neighbourhood
        6: ("Fox", "SUB_B1", "t"),
    }
    for lid in range(1, 13):
        host = (lid - 1) // 2 + 1
        name, suburb, sup = hosts[host]
        nb = "alpha" if lid % 3 else "Beta"
        if lid == 12 and month == 4:
            nb = "Gamma"                    # latest neighbourhood differs (SCD1)
        avail = "f" if (lid + month) % 4 == 0 else "t"
        if lid == 7 and month == 2:
            avail = "NULL"                  # NULL availability (Q-17)
        price = str(50 + lid * 10 + month)
        if lid == 5 and month == 3:
            price = ""                      # NULL price
        acc = "4.6" if lid == 3 else str(1 + lid % 4)
        rating = "NUL" if lid == 9 else str(80 + lid)
        rows.append([str(lid), "99", f"{10 + month:02d}/{month:02d}/2021", str(host), name,
                     "01/01/2015", sup, suburb, nb, "Apartment" if lid % 2 else "House",
                     "Entire home" if lid % 4 else "Private room", acc, price, avail,
                     str((lid * 3 + month) % 30), str(lid), rating] + ["9"] * 5)
    if month == 4:  # host 1's listing 1 twice in the latest month -> dim ties (Q-06)
        dup = list(rows[0])
        dup[10] = "Private room"
        rows.append(dup)
    return rows


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def write_fixture(root: str, months=(1, 2, 3, 4)) -> str:
    os.makedirs(root, exist_ok=True)
    write_csv(os.path.join(root, "NSW_LGA_CODE.csv"), "LGA_CODE,LGA_NAME", [list(r) for r in LGA_CODE])
    write_csv(os.path.join(root, "NSW_LGA_SUBURB.csv"), "LGA_NAME,SUBURB_NAME",
              [list(r) for r in LGA_SUBURB])
    write_csv(os.path.join(root, "Census_G01_NSW_LGA.csv"), ",".join(f"h{i}" for i in range(36)), g01_rows())
    write_csv(os.path.join(root, "Census_G02_NSW_LGA.csv"), ",".join(f"h{i}" for i in range(9)), g02_rows())
    for m in months:
        write_listing_month(root, m)
    return root


def write_listing_month(root: str, month: int):
    sub = os.path.join(root, "listings")
    os.makedirs(sub, exist_ok=True)
    write_csv(os.path.join(sub, f"{month:02d}_2021.csv"), HEADER_LISTING, listing_rows(month))
