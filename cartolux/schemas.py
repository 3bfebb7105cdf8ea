"""Record layouts of map and alignment files, with the header spellings they are met under."""

from __future__ import annotations

# Column names and types of the two public map formats.
CMAP = {
    "CMapId": "long", "ContigLength": "double", "NumSites": "int", "SiteID": "int", "LabelChannel": "int",
    "Position": "double", "StdDev": "double", "Coverage": "double", "Occurrence": "double", "ChimQuality": "double",
    "SegDupL": "double", "SegDupR": "double", "FragileL": "double", "FragileR": "double", "OutlierFrac": "double",
    "ChimNorm": "double", "Mask": "int", "Strand": "string",
}
XMAP = {
    "XmapEntryID": "long", "QryContigID": "long", "RefContigID": "long", "QryStartPos": "double", "QryEndPos": "double",
    "RefStartPos": "double", "RefEndPos": "double", "Orientation": "string", "Confidence": "double", "HitEnum": "string",
    "QryLen": "double", "RefLen": "double", "LabelChannel": "int", "Alignment": "string",
}
CONFLICT = {
    "xId": "long", "ref": "string", "refId": "long", "refLeftBkpt": "double", "refRightBkpt": "double", "refOrientation": "string",
    "refLeftBkptStatus": "string", "refRightBkptStatus": "string", "refStatus": "string", "qry": "string", "qryId": "long",
    "qryLeftBkpt": "double", "qryRightBkpt": "double", "qryOrientation": "string", "qryLeftBkptStatus": "string",
    "qryRightBkptStatus": "string", "qryStatus": "string", "remark": "string",
}

# Other spellings of a column, compared without case and without anything but letters and digits.
ALIASES = {
    "LabelChannel": ["LabelChan", "LblCh", "Channel", "ChannelNo", "ColourChannel", "ColorChannel"],
    "ChimQuality": ["ChimQual", "ChimQ", "ChimericQuality", "QualityChim"],
    "Coverage": ["Cov", "Depth"],
    "Occurrence": ["Occ", "Occurence"],
    "NumSites": ["SiteCount"],
    "Position": ["Pos", "SitePosition"],
    "StdDev": ["SD"],
    "Orientation": ["Ori", "Orient", "QryOrient", "AlignOrientation", "Direction", "Sense"],
    "Confidence": ["Confidenence", "ConfScore"],
    "HitEnum": ["HitString"],
    "RefContigID": ["ReferenceID"],
}

# Codings of values that files use beside the plain ones, compared as written.
PLUS = ["+", "1", "+1", "F", "fwd", "forward", "plus"]
MINUS = ["-", "-1", "R", "rev", "reverse", "minus"]

FORMATS = {"CMAP": CMAP, "XMAP": XMAP}


def spelling(name: str) -> str:
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())


def spellings(kind: str) -> dict[str, str]:
    """Normalised header spelling -> column, for one kind of file."""
    known = FORMATS[kind]
    out = {spelling(alias): column for column, names in ALIASES.items() if column in known for alias in names}
    return out | {spelling(column): column for column in known}
