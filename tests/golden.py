"""Published counts of the unified table, as (value, rows). Fixed values."""

# 501(c) type, then rows with PF code 0, 1, 2, 3 and without one
TYPE_BY_PF_CODE = [
    ("00", 27, 0, 0, 0, 226),
    ("01", 709, 0, 0, 0, 91),
    ("02", 4295, 0, 0, 0, 5386),
    ("03", 1452651, 144762, 20, 237, 905717),
    ("04", 75102, 0, 0, 0, 112333),
    ("05", 45202, 0, 0, 0, 46128),
    ("06", 61227, 0, 0, 0, 57316),
    ("07", 48675, 0, 0, 0, 48116),
    ("08", 38539, 0, 0, 0, 72095),
    ("09", 5587, 0, 0, 0, 13978),
    ("10", 15446, 0, 0, 0, 14302),
    ("11", 6, 0, 0, 0, 6),
    ("12", 5449, 0, 0, 0, 2770),
    ("13", 9692, 0, 0, 0, 4235),
    ("14", 1529, 0, 0, 0, 4136),
    ("15", 623, 0, 0, 0, 1849),
    ("16", 11, 0, 0, 0, 16),
    ("17", 87, 0, 0, 0, 541),
    ("18", 3, 0, 0, 0, 3),
    ("19", 26908, 0, 0, 0, 30852),
    ("20", 1, 0, 0, 0, 64),
    ("21", 2, 0, 0, 0, 28),
    ("23", 2, 0, 0, 0, 1),
    ("24", 0, 0, 0, 0, 2),
    ("25", 594, 0, 0, 0, 2186),
    ("26", 5, 0, 0, 0, 6),
    ("27", 14, 0, 0, 0, 4),
    ("29", 15, 0, 0, 0, 8),
    ("40", 220, 0, 0, 0, 30),
    ("50", 4, 1, 0, 0, 25),
    ("70", 0, 0, 0, 0, 1),
    ("71", 1, 0, 0, 0, 0),
    ("80", 0, 0, 0, 0, 1383),
    ("81", 1, 0, 0, 0, 0),
    ("82", 11, 0, 0, 0, 18),
    ("90", 0, 0, 0, 0, 790),
    ("91", 666, 1, 0, 0, 695),
    ("92", 140, 5894, 1, 0, 3493),
    ("93", 0, 0, 0, 0, 2440),
    (None, 0, 0, 0, 0, 187369),
]

TYPE_COUNTS = [
    ("00", 253), ("01", 800), ("02", 9681), ("03", 2503387), ("04", 187435), ("05", 91330),
    ("06", 118543), ("07", 96791), ("08", 110634), ("09", 19565), ("10", 29748), ("11", 12),
    ("12", 8219), ("13", 13927), ("14", 5665), ("15", 2472), ("16", 27), ("17", 628), ("18", 6),
    ("19", 57760), ("20", 65), ("21", 30), ("23", 3), ("24", 2), ("25", 2780), ("26", 11),
    ("27", 18), ("29", 23), ("40", 250), ("50", 30), ("70", 1), ("71", 1), ("80", 1383),
    ("81", 1), ("82", 29), ("90", 790), ("91", 1362), ("92", 9528), ("93", 2440), (None, 187369),
]

FILING_COUNTS = [
    (0, 221065), (1, 570568), (2, 1126372), (3, 6856), (4, 14), (6, 279358), (7, 747),
    (10, 118332), (11, 671), (13, 8701), (14, 2602), (20, 475818), (21, 64), (30, 179), (40, 17),
    (60, 12620), (70, 27), (130, 1213), (140, 67), (888, 1), (None, 637707),
]

PF_COUNTS = {"0": 1793444, None: 1518639, "1": 150658, "3": 237, "2": 21}

TOTAL = 3462999

# after imputation
PF_IMPUTED = {"0": 2215506, "1": 150656, "2": 21, "3": 237, None: 1096579}

# after recoding, before private foundations are told apart
FILING_RECODED = {
    "02": 1602190, "01": 688900, None: 637708, "06": 291978, "00": 221065, "13": 9914,
    "03": 7035, "14": 2669, "07": 774, "11": 671, "21": 64, "04": 31,
}

VERTEX_SIZES = {
    "501C_01": 28.28427, "501C_02": 98.39207, "501C_04": 432.93764, "501C_05": 302.20854,
    "501C_06": 344.30074, "501C_07": 311.11252,
}

NTEEV2 = {"B29": "EDU-B29-RG", "B01": "EDU-B00-AA", "B0129": "EDU-B29-AA"}
