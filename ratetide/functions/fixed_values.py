"""Fixed values that must equal the reference's for right results.

FIXED VALUES -- stated plainly, in the reference's natural order:

* the county -> broad-region map (116 counties in 10 regions, plus the
  catch-all for everything else, NULL included),
* the property-type labels,
* the policy-rate history (69 dated rates),
* the configured minimum transaction date.
"""

from __future__ import annotations

# ---- FIXED VALUES (must match the reference) --------------------------------

CATCH_ALL_REGION = "Other England"

MIN_TRANSACTION_DATE = "1997-01-01"

COUNTY_TO_REGION: dict[str, list[str]] = {
    "London": ["GREATER LONDON"],
    "South East": [
        "SURREY", "KENT", "EAST SUSSEX", "WEST SUSSEX", "HAMPSHIRE", "BERKSHIRE",
        "BUCKINGHAMSHIRE", "OXFORDSHIRE", "HERTFORDSHIRE", "ESSEX", "BRACKNELL FOREST",
        "ISLE OF WIGHT", "MEDWAY", "MILTON KEYNES", "READING", "SLOUGH",
        "SOUTHEND-ON-SEA", "THURROCK", "PORTSMOUTH", "SOUTHAMPTON", "BRIGHTON AND HOVE",
        "WEST BERKSHIRE", "WINDSOR AND MAIDENHEAD", "WOKINGHAM",
    ],
    "East of England": [
        "NORFOLK", "SUFFOLK", "CAMBRIDGESHIRE", "BEDFORD", "CENTRAL BEDFORDSHIRE",
        "LUTON", "CITY OF PETERBOROUGH",
    ],
    "South West": [
        "DEVON", "CORNWALL", "DORSET", "SOMERSET", "WILTSHIRE", "GLOUCESTERSHIRE",
        "BATH AND NORTH EAST SOMERSET", "CITY OF BRISTOL", "NORTH SOMERSET",
        "SOUTH GLOUCESTERSHIRE", "CITY OF PLYMOUTH", "ISLES OF SCILLY", "SWINDON",
        "TORBAY", "BOURNEMOUTH, CHRISTCHURCH AND POOLE",
    ],
    "East Midlands": [
        "DERBYSHIRE", "LEICESTERSHIRE", "LINCOLNSHIRE", "NORTHAMPTONSHIRE",
        "NOTTINGHAMSHIRE", "RUTLAND", "CITY OF DERBY", "LEICESTER", "CITY OF NOTTINGHAM",
        "NORTH EAST LINCOLNSHIRE", "NORTH LINCOLNSHIRE", "NORTH NORTHAMPTONSHIRE",
        "WEST NORTHAMPTONSHIRE",
    ],
    "West Midlands": [
        "STAFFORDSHIRE", "WEST MIDLANDS", "HEREFORDSHIRE", "SHROPSHIRE", "WREKIN",
        "STOKE-ON-TRENT", "WORCESTERSHIRE", "WARWICKSHIRE",
    ],
    "North West": [
        "LANCASHIRE", "GREATER MANCHESTER", "MERSEYSIDE", "CUMBRIA", "HALTON",
        "BLACKBURN WITH DARWEN", "BLACKPOOL", "CHESHIRE EAST", "CHESHIRE WEST AND CHESTER",
        "CUMBERLAND", "WARRINGTON", "WESTMORLAND AND FURNESS",
    ],
    "North East": [
        "TYNE AND WEAR", "COUNTY DURHAM", "NORTHUMBERLAND", "HARTLEPOOL", "MIDDLESBROUGH",
        "REDCAR AND CLEVELAND", "STOCKTON-ON-TEES", "DARLINGTON",
    ],
    "Yorkshire & Humber": [
        "SOUTH YORKSHIRE", "NORTH YORKSHIRE", "WEST YORKSHIRE", "EAST RIDING OF YORKSHIRE",
        "CITY OF KINGSTON UPON HULL", "YORK",
    ],
    "Wales": [
        "CARDIFF", "SWANSEA", "NEWPORT", "BRIDGEND", "CAERPHILLY", "CARMARTHENSHIRE",
        "CEREDIGION", "CONWY", "DENBIGHSHIRE", "FLINTSHIRE", "GWYNEDD", "ISLE OF ANGLESEY",
        "MERTHYR TYDFIL", "MONMOUTHSHIRE", "NEATH PORT TALBOT", "PEMBROKESHIRE", "POWYS",
        "RHONDDA CYNON TAFF", "THE VALE OF GLAMORGAN", "TORFAEN", "BLAENAU GWENT", "WREXHAM",
    ],
}

PROPERTY_TYPE_LABELS: dict[str, str] = {
    "D": "Detached",
    "S": "Semi-detached",
    "T": "Terraced",
    "F": "Flat",
    "O": "Other",
}

RATE_HISTORY: list[tuple[str, float]] = [
    ("1997-06-06", 6.50), ("1997-07-10", 6.75), ("1997-08-07", 7.00),
    ("1997-11-06", 7.25), ("1998-06-04", 7.50), ("1998-10-08", 7.25),
    ("1998-11-05", 6.75), ("1998-12-10", 6.25), ("1999-01-07", 6.00),
    ("1999-02-04", 5.50), ("1999-04-08", 5.25), ("1999-06-10", 5.00),
    ("1999-09-08", 5.25), ("2000-02-10", 6.00), ("2001-02-08", 5.75),
    ("2001-04-05", 5.50), ("2001-05-10", 5.25), ("2001-08-02", 5.00),
    ("2001-09-18", 4.75), ("2001-10-04", 4.50), ("2001-11-08", 4.00),
    ("2002-11-07", 3.75), ("2003-02-06", 3.75), ("2003-07-10", 3.50),
    ("2004-02-05", 4.00), ("2004-05-06", 4.25), ("2004-06-10", 4.50),
    ("2004-08-05", 4.75), ("2004-11-04", 4.75), ("2005-08-04", 4.50),
    ("2006-08-03", 4.75), ("2006-11-09", 5.00), ("2007-01-11", 5.25),
    ("2007-05-10", 5.50), ("2007-07-05", 5.75), ("2007-12-06", 5.50),
    ("2008-02-07", 5.25), ("2008-04-10", 5.00), ("2008-10-08", 4.50),
    ("2008-11-06", 3.00), ("2008-12-04", 2.00), ("2009-01-08", 1.50),
    ("2009-02-05", 1.00), ("2009-03-05", 0.50), ("2016-08-04", 0.25),
    ("2017-11-02", 0.50), ("2018-08-02", 0.75), ("2020-03-11", 0.25),
    ("2020-03-19", 0.10), ("2021-12-16", 0.25), ("2022-02-03", 0.50),
    ("2022-03-17", 0.75), ("2022-05-05", 1.00), ("2022-06-16", 1.25),
    ("2022-08-04", 1.75), ("2022-09-22", 2.25), ("2022-11-03", 3.00),
    ("2022-12-15", 3.50), ("2023-02-02", 4.00), ("2023-03-23", 4.25),
    ("2023-05-11", 4.50), ("2023-06-22", 5.00), ("2023-08-03", 5.25),
    ("2024-08-01", 5.00), ("2024-11-07", 4.75), ("2025-02-06", 4.50),
    ("2025-05-08", 4.25), ("2025-08-07", 4.00), ("2025-12-18", 3.75),
]

# ---- end of fixed values -----------------------------------------------------


def county_map_rows() -> list[tuple[str, str]]:
    """(county_key, broad_region) pairs in the order given above."""
    return [(county, region) for region, counties in COUNTY_TO_REGION.items()
            for county in counties]
