"""Ordered keyword rules: the function of a scene, the purpose of a segment, the title of a beat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (words, function); the first rule of which a word occurs decides.
SCENE_RULES = [
    (("black screen", "title sequence", "distorted text", "opening title"), "SETUP"),
    (("birthday", "champagne", "dancing", "nightclub"), "INTRODUCTION"),
    (("tape recorder", "ancient history", "kunda", "burlap", "package"), "DISCOVERY"),
    (("struggling", "struggles in open water", "face down in the mud", "attack"), "ESCALATION"),
    (("jared, where are you", "cramped metallic shelter", "got you, buddy"), "RESOLUTION"),
    (("leaving", "don't answer that", "argue", "breach"), "CONFLICT"),
]
#: Fixed values: (words of the title, scene functions that must all be there, purpose, spoiler level); either decides.
PURPOSE_RULES = [
    (("prologue",), ("SETUP", "DISCOVERY"), "opening_hook_and_audio_discovery", "none"),
    (("storm", "escalation", "conflict"), (), "rising_action_and_crisis", "moderate"),
    (("nightclub", "birthday", "introduction"), (), "setting_shift_and_character_intro", "none"),
    (("climax",), ("CLIMAX",), "peak_climax", "high"),
    (("transition",), (), "atmospheric_transition", "none"),
]
STORY = ("story_progression", "none")


def says(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def scene_function(text: Column, significance: Column, first: Column, rules=SCENE_RULES) -> Column:
    """By the words of all that is said and seen, else by the highest significance, else by the place. A null text says nothing."""
    low = F.lower(F.coalesce(text, F.lit("")))
    case = reduce(lambda c, r: c.when(says(low, r[0]), r[1]), rules, F.when(F.lit(False), ""))
    return case.when(significance >= 9, "CLIMAX").when(significance >= 7, "ESCALATION").when(first, "SETUP").otherwise("TRANSITION")


def purpose(title: Column, scene_functions: Column, rules=PURPOSE_RULES) -> Column:
    """struct(purpose, spoiler_level)."""
    low = F.lower(F.coalesce(title, F.lit("")))
    have = F.coalesce(scene_functions, F.array().cast("array<string>"))
    out = lambda name, level: F.struct(F.lit(name).alias("purpose"), F.lit(level).alias("spoiler_level"))

    def applies(words, needed):
        all_there = reduce(lambda a, b: a & b, [F.array_contains(have, f) for f in needed]) if needed else F.lit(False)
        return says(low, words) | all_there

    return reduce(lambda c, r: c.when(applies(r[0], r[1]), out(*r[2:])), rules, F.when(F.lit(False), out(*STORY))).otherwise(out(*STORY))


def weight(importance: Column, purpose: Column, cast_size: Column) -> Column:
    """Importance from 1 to 10; a transition without characters weighs 1."""
    return F.when((purpose == "atmospheric_transition") & (cast_size == 0), 1.0).otherwise(F.greatest(F.lit(1), F.least(F.lit(10), importance)).cast("double"))
