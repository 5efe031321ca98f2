"""Sample rows of the four feeds by batch date (fixed values), written as CSV landing folders."""

from __future__ import annotations

from pathlib import Path

from tallyline.plans import trials

STUDIES = {
    "2026-01-01": [
        "STUDY-1001,LUNG-101,P-1001,SPN-001,NYC01,Dr. Maria Chen,Oncology,Active,2025-01-10,2027-12-31",
        "STUDY-2200,CARDIO-220,P-2200,SPN-002,BOS02,Dr. Ethan Brooks,Cardiology,Active,2024-11-01,2026-11-15",
        "STUDY-3300,NEURO-330,P-3300,SPN-003,SFO03,Dr. Priya Raman,Neurology,Closed,2023-02-20,2025-12-15",
    ],
    "2026-01-15": ["STUDY-4400,IMMUNO-440,,SPN-001,CHI04,Dr. Lily Tran,Immunology,Planned,2026-03-01,2028-12-01"],
    "2026-02-01": ["STUDY-3300,NEURO-330,P-3300,SPN-003,SFO03,Dr. Priya Raman,Neurology,Closed,2023-02-20,2025-12-15"],
    "2026-02-15": ["STUDY-5500,RARE-550,P-5500,SPN-004,DAL05,Dr. Samuel Ortega,Rare Disease,Active,2026-02-14,2029-03-31"],
}
CONTRACTS = {
    "2026-01-01": [
        "CNT-9001,ACME-LUNG-2026,LUNG-101,P-1001,SPN-001,NYC01,Active,750000.0,2025-01-01,0",
        "CNT-9002,NW_CARDIO_2026,CARDIO-220,P-2200,SPN-002,BOS02,Active,500000.0,2024-11-01,1",
        "CNT-9003,Global Trial Neuro 330,NEURO-330,P-3300,SPN-003,SFO03,Closed,315000.0,2023-02-01,2",
    ],
    "2026-01-15": ["CNT-9004,ACME_LUNG_2026,LUNG-101,P-1001,SPN-001,NYC01,Active,785000.0,2026-01-15,1"],
    "2026-02-01": ["CNT-9002,NW-CARDIO-2026,CARDIO-220,P-2200,SPN-002,BOS02,Active,540000.0,2026-02-01,2"],
    "2026-02-15": ["CNT-9010,RARE550|MASTER,RARE-550,P-5500,SPN-004,DAL05,Active,910000.0,2026-02-15,0"],
}
INVOICES = {
    "2026-01-01": [
        "INV-0001,GP-10001,ACME LUNG 2026,P-1001,SPN-001,120000.0,60000.0,60000.0,2026-01-01,Partially Paid",
        "INV-0002,GP-10002,NW-CARDIO-2026,P-2200,SPN-002,90000.0,90000.0,0.0,2026-01-03,Paid",
        "INV-0003,GP-10003,Global Trial Neuro 330,P-3300,SPN-003,45000.0,10000.0,35000.0,2025-12-20,Partially Paid",
    ],
    "2026-01-15": [
        "INV-0004,GP-10004,ACME-LUNG-2026,P-1001,SPN-001,50000.0,0.0,50000.0,2026-01-14,Unpaid",
        "INV-0004,GP-10004,ACME-LUNG-2026,P-1001,SPN-001,50000.0,0.0,50000.0,2026-01-14,Unpaid",
    ],
    "2026-02-01": ["INV-0005,GP-10005,Global Trial Neuro 330,P-3300,SPN-003,25000.0,0.0,25000.0,2026-01-31,Unpaid"],
    "2026-02-15": ["INV-0006,GP-10006,RARE 550 MASTER,,SPN-004,15000.0,0.0,15000.0,2026-02-15,Unpaid"],
}
SPONSORS = {
    "2026-01-01": [
        "SPN-001,Acme Biopharma,Acme Holdings,BA-1001,NS-CUST-ACME,Active",
        "SPN-002,Northwind Pharmaceuticals,Northwind Group,BA-2001,NS-CUST-NW,Active",
        "SPN-003,Global Trial Therapeutics,GTT Parent,BA-3001,NS-CUST-GTT,Active",
    ],
    "2026-01-15": ["SPN-001,ACME Biopharma,Acme Holdings,BA-1001,NS-CUST-ACME,Active"],
    "2026-02-01": ["SPN-002,Northwind Pharma,Northwind Group,BA-2001,NS-CUST-NW,Active"],
    "2026-02-15": ["SPN-004,RareCure Biotech,RareCure Group,BA-4001,NS-CUST-RC,Pending"],
}
FEEDS = {
    "studies": (STUDIES, trials.STUDY_COLUMNS),
    "contracts": (CONTRACTS, trials.CONTRACT_COLUMNS),
    "invoices": (INVOICES, trials.INVOICE_COLUMNS),
    "sponsors": (SPONSORS, trials.SPONSOR_COLUMNS),
}

_TRUE = [("STUDY-2200", "CNT-9002"), ("STUDY-3300", "CNT-9003"), ("STUDY-5500", "CNT-9010")]
_FALSE = [
    ("STUDY-1001", "CNT-0000"),
    ("STUDY-0000", "CNT-9002"),
    ("STUDY-2200", "CNT-9999"),
    ("STUDY-3300", "CNT-9002"),
    ("STUDY-3300", "CNT-9010"),
    ("STUDY-4400", "CNT-9003"),
    ("STUDY-5500", "CNT-1234"),
]
LABELS = [(*pair, "TRUE") for pair in _TRUE * 11] + [(*pair, "FALSE") for pair in _FALSE]


def land(root: Path, batches=None) -> dict[str, str]:
    """Write the feeds; returns feed -> glob."""
    globs = {}
    for name, (rows, columns) in FEEDS.items():
        for batch, lines in rows.items():
            if batches is not None and batch not in batches:
                continue
            folder = root / name / f"batch_date={batch}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{name}.csv").write_text("\n".join([",".join(columns), *lines]) + "\n")
        globs[name] = f"{root}/{name}/batch_date=*/*.csv"
    return globs
