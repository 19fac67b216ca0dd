"""Seeded fixtures in the shape of the raw extracts, small enough for brute force."""

from __future__ import annotations

import random
from datetime import date, timedelta

from wardline.sources.columns import CONDITION_CODES

START = date(2008, 1, 1)


def beneficiaries(n=120, seed=42):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        birth = date(rng.randint(1920, 1959), rng.randint(1, 12), rng.randint(1, 28))
        row = {
            "DESYNPUF_ID": f"BENE{i:06d}",
            "BENE_BIRTH_DT": birth.strftime("%Y%m%d"),
            "BENE_DEATH_DT": (START + timedelta(days=rng.randint(0, 1000))).strftime("%Y%m%d") if i % 15 == 0 else None,
            "BENE_SEX_IDENT_CD": str(rng.choice([1, 2])),
            "BENE_RACE_CD": str(rng.randint(1, 6)),
            "BENE_HI_CVRAGE_TOT_MONS": str(rng.randint(0, 12)),
            "BENE_HMO_CVRAGE_TOT_MONS": str(rng.randint(0, 12)),
            "MEDREIMB_IP": f"{rng.uniform(0, 9000):.2f}",
        }
        row.update({c: str(rng.choices([0, 1, 2], [6, 2, 1])[0]) for c in CONDITION_CODES})
        rows.append(row)
    return rows


def inpatient(n=900, patients=120, seed=7, hot_share=0.33):
    """Claims with planted signal: non-routine discharges are followed by readmissions.

    One patient holds about a third of all claims.
    """
    rng = random.Random(seed)
    rows, number = [], 0
    while len(rows) < n:
        who = 0 if rng.random() < hot_share else rng.randrange(patients)
        admit = START + timedelta(days=rng.randrange(1050))
        while admit is not None and len(rows) < n:
            los = rng.randint(0, 9)
            status = rng.choice([1, 1, 1, 2, 3, 6, 20, 30, 99])
            discharge = admit + timedelta(days=los)
            rows.append(
                {
                    "CLM_ID": f"CLM{number:08d}",
                    "DESYNPUF_ID": f"BENE{who:06d}",
                    "CLM_ADMSN_DT": admit.strftime("%Y%m%d"),
                    "NCH_BENE_DSCHRG_DT": None if rng.random() < 0.02 else discharge.strftime("%Y%m%d"),
                    "PRVDR_NUM": None if rng.random() < 0.02 else f"PROV{rng.randint(1, 7):03d}",
                    "CLM_DRG_CD": str(rng.randint(1, 40)),
                    "CLM_ADMSN_SOURCE_CD": str(rng.randint(1, 8)),
                    "CLM_IP_ADMSN_TYPE_CD": str(rng.randint(1, 3)),
                    "PTNT_DSCHRG_STUS_CD": str(status),
                    "CLM_PMT_AMT": f"{500 + 900 * los + rng.uniform(0, 800):.2f}",
                    "CLM_PASS_THRU_AMT": f"{rng.uniform(0, 500):.2f}",
                    "CLM_UTLZTN_DAY_CNT": str(los),
                    "ICD9_DGNS_CD_1": f"{rng.randint(100, 999)}",
                    "ICD9_DGNS_CD_2": None if rng.random() < 0.3 else f" {rng.randint(100, 999)} ",
                }
            )
            number += 1
            again = rng.random() < (0.75 if status != 1 else 0.1)
            admit = discharge + timedelta(days=rng.randint(1, 25)) if again else None
    return rows


def write_csv(rows, path):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
