"""Schemas and fixed values of the dialogue data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TARGET = _struct(entity=_S, subject_id=_S, attr=_S)
CRITICAL_TOKEN = _struct(position=_I, token_id=_I, decoded_value=_S, loss=_D, pred_token_id=_I, pred_decoded_value=_S)
LOSS_METRICS = _struct(completion_difficulty=_D, mean_loss=_D, worst_loss=_D, critical_token=CRITICAL_TOKEN)
#: One line of a JSONL entry file.
ENTRY = T.StructType(
    [
        *_struct(prompt=_S, id=_S, source_id=_S, target=TARGET, loss_metrics=LOSS_METRICS, expected_value=_S, original_subject_id=_S).fields,
        *_struct(completion=_S, response=_S).fields,
    ]
)
SUBJECT = _struct(key=_S, id=_S)
#: cls tells entities of one family apart; attr_order keeps the written order, repeats included.
ENTITY = _struct(cls=_S, family=_S, tag=_S, subject=SUBJECT, attrs=T.MapType(_S, _S), attr_order=T.ArrayType(_S), text=_S)
DATAPOINT = _struct(
    previous_message=ENTITY, message=ENTITY, previous_state=T.ArrayType(ENTITY), state_context=T.ArrayType(ENTITY), state=T.ArrayType(ENTITY),
    target=TARGET, source_id=_S, original_subject_id=_S, _file=_S, _line=_I, _part=_I,
)

# Fixed values of the data format.
NO_CHANGE = "!!no_change!!"
UPDATED = "updated"
HIGH_DIFFICULTY, MEDIUM_DIFFICULTY, LOW_DIFFICULTY = 1.0, 0.25, 0.0
EVAL_MIN_DIFFICULTY = 0.05
#: (class, stat, stats it depends on, order, concrete)
STATS = [
    ("CharacterStats", "pose", [], 0, True),
    ("CharacterStats", "location", ["pose"], 1, True),
    ("CharacterStats", "outfit", [], 2, True),
    ("CharacterStats", "exposure", ["outfit"], 3, True),
    ("CharacterStats", "accessories", ["outfit"], 4, True),
    ("CharacterStats", "mood", [], 5, False),
    ("CharacterStats", "bodystate", [], 6, True),
    ("SceneStats", "fixtures", [], 0, True),
    ("SceneStats", "items", ["fixtures"], 1, True),
    ("SceneStats", "passages", [], 2, True),
]
#: The place of a stat that no class knows.
UNKNOWN_ORDER = 9999
#: The grammar of annotated texts: anchors, attributes, self-closing tags.
ANCHOR_PATTERN = r"<(previousMessage|message)([^>]*)>"
ATTR_PATTERN = r'(\w+)\s*=\s*"((?:[^"\\]|\\.)*)"'
TAG_PATTERN = r"<([A-Za-z][\w\-]*)\s*([^/>]*?)\s*/>"
#: Attributes that can hold a message's date, speaker and role, the first one first.
DATE_ATTRS = ["send_date", "timestamp", "time", "date", "datetime", "sent"]
SPEAKER_ATTRS = ["from", "name", "speaker", "character", "author"]
ROLE_ATTRS = ["role", "class", "type"]
#: Words for true in marks, and for true and false in flags.
MARK_WORDS = ["1", "true", "yes", "y", "on"]
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "f", "no", "n", "off"]
#: Strings whose tokens open a new block of a value; the token after one counts fully.
BLOCK_DELIMITERS = [",", ";", " (", "(", " {", "{", " [", "["]
#: Attribute that names the subject, by tag and class; the first that is there wins.
TAGS = {"stats": [("CharacterStats", "character"), ("SceneStats", "scene")], "character": [("CharacterEntity", "name")]}
STATS_CLASSES = ["CharacterStats", "SceneStats"]
