"""String functions over labels, descriptions and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrykit.functions.domain import filled

POSITION_WORDS = tuple(
    """
    back big bottom first front inner large left little lower main outer rear right second small top upper
    """.split()
)
PHRASE_BREAKS = ("with", "having", "featuring", "including", "and")
ADJECTIVES = tuple(
    """
    a an big black blue classic decorative green large little metal modern new old ornate plastic red round short simple small square stylish
    tall the vintage white wooden
    """.split()
)
#: Words of colour, finish and material; words of form and size.
APPEARANCE_WORDS = tuple(
    """
    aged aluminum beige black blue brick bright bronze brown brushed burgundy ceramic checkered chrome concrete copper corroded cotton cream
    crimson dark deep denim fabric faded feathered frosted fur glass glossy gold golden gray green grey grooved iridescent iron ivory knurled
    leather light linen marble maroon matte metallic navy opaque orange oxidized pale patterned pink plain plastic polished purple red ribbed
    ridged rough rubber rustic shiny silk silver smooth solid steel stone striped suede tan tarnished teal textured titanium translucent
    transparent velvet vibrant weathered white wooden worn woven yellow
    """.split()
)
STRUCTURE_WORDS = tuple(
    """
    aerodynamic angular bell-shaped blocky blunt boxy bulbous bulky circular compact concave conical convex curved cylindrical dome-shaped
    elongated flared flat hexagonal large long massive narrow oblong octagonal oval pointed rectangular round rounded short slender slim small
    spherical square streamlined stubby tall tapered teardrop thick thin tiny triangular wedge-shaped wide
    """.split()
)
#: What a deletion says -> what undoes it.
UNDO = {"Add": ("Remove", "Delete", "Take away", "Get rid of", "Eliminate", "Strip"), "Attach": ("Detach", "Cut off"), "Put on": ("Take off",)}


def normal_category(x: Column, stop=POSITION_WORDS) -> Column:
    """Words of a label without positions, numbers and blanks, joined by underscores; the lower-case label if none is left."""
    words = F.filter(F.split(F.lower(F.trim(x)), "[_\\-\\s]+"), lambda w: (w != "") & ~w.isin(*stop) & ~w.rlike("^\\p{Nd}+$"))
    return F.coalesce(filled(F.array_join(words, "_")), F.lower(x))


def object_type(description: Column, adjectives=ADJECTIVES) -> Column:
    """The noun of a description: of what stands before the first phrase break the last word that is no adjective, in letters alone; the last word as it is if all are."""
    head = F.element_at(F.split(F.lower(description), "\\s+(?:" + "|".join(PHRASE_BREAKS) + ")\\s+"), 1)
    words = F.filter(F.split(head, "\\s+"), lambda w: w != "")
    nouns = F.filter(F.transform(words, lambda w: F.regexp_replace(w, "[^a-z]", "")), lambda w: (w != "") & ~w.isin(*adjectives))
    return F.coalesce(F.try_element_at(nouns, F.lit(-1)), F.try_element_at(words, F.lit(-1)), F.lit(""))


def human_label(label: Column) -> Column:
    return F.trim(F.replace(label, F.lit("_"), F.lit(" ")))


def part_phrase(desc: Column, label: Column, part_id: Column) -> Column:
    return F.coalesce(filled(F.trim(desc)), filled(human_label(label)), F.concat(F.lit("part "), part_id.cast("string")))


def fill_template(template: Column, **values: Column) -> Column:
    """``{name}`` replaced by each value."""
    for name, v in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), v)
    return template


def reversed_prompt(prompt: Column) -> Column:
    """A prompt that undoes a deletion; nothing for a blank one."""
    asked, made = F.trim(prompt), F.when(F.coalesce(F.trim(prompt), F.lit("")) == "", F.lit(""))
    for put, said in UNDO.items():
        pattern = "(?i)^(?:" + "|".join(said) + ")\\s+"
        made = made.when(asked.rlike(pattern), F.regexp_replace(asked, pattern, put + " "))
    return made.otherwise(F.concat(F.lit("Add back "), F.lower(F.substring(asked, 1, 1)), F.substring(asked, 2, 2**31 - 2)))


def without_words(text: Column, words) -> Column:
    """The text without words of a set (compared without the punctuation around them), with single spaces and none before commas and stops."""
    edge = "[.,;:!?()\\[\\]\"']+"
    kept = F.filter(F.split(text, "\\s+"), lambda w: (w != "") & ~F.lower(F.regexp_replace(w, f"^{edge}|{edge}$", "")).isin(*words))
    return F.trim(F.regexp_replace(F.array_join(kept, " "), " ([,.])", "$1"))


def structure_of(text: Column) -> Column:
    return without_words(text, APPEARANCE_WORDS)


def appearance_of(text: Column) -> Column:
    return without_words(text, STRUCTURE_WORDS)


def edit_prompt(edit_type: Column, prompt: Column, part: Column, obj: Column) -> Column:
    """The instruction for a two-dimensional edit."""
    return (
        F.when(edit_type == "modification", F.concat_ws("", F.lit("Change the "), part, F.lit(" of this "), obj, F.lit(": "), prompt))
        .when(edit_type == "scale", F.concat_ws("", F.lit("Resize the "), part, F.lit(" of this "), obj, F.lit(": "), prompt))
        .when(edit_type == "global", F.concat_ws("", F.lit("Restyle this "), obj, F.lit(": "), prompt))
        .otherwise(F.concat_ws("", F.lit("Edit this "), obj, F.lit(": "), prompt))
    )


def judge_prompt(prompt: Column) -> Column:
    asked = filled(F.trim(prompt))
    return F.when(asked.isNull(), F.lit("Compare before and after. No instruction was given; judge the visible change.")).otherwise(F.concat(F.lit("Compare before and after. Instruction: "), asked))


def prompt_bundle(obj: Column, before: Column, after: Column, part_before: Column, part_after: Column, prompt: Column) -> Column:
    """The prompts of one edit, whole and by channel."""
    parts = {"object": obj, "before": before, "after": after, "part_before": part_before, "part_after": part_after}
    made = []
    for name, c in parts.items():
        full = F.coalesce(c, F.lit(""))
        made += [full.alias(name), structure_of(full).alias(f"{name}_structure"), appearance_of(full).alias(f"{name}_appearance")]
    return F.struct(*made, F.coalesce(prompt, F.lit("")).alias("prompt"))


def label_list(labels: Column) -> Column:
    """``p0=wheel, p1=door``."""
    return F.array_join(F.transform(labels, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit("="), x)), ", ")


def short_caption(captions: Column) -> Column:
    """The first caption that is not blank, with single spaces."""
    return F.coalesce(F.get(F.filter(F.transform(captions, lambda c: F.trim(F.regexp_replace(c, "\\s+", " "))), lambda c: c != ""), F.lit(0)), F.lit(""))


def clean_category(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("&&"), F.lit(" and ")), F.lit("-"), F.lit(" "))


def wrapped(text: Column, width: int) -> Column:
    """Lines of at most ``width`` characters, broken at spaces."""
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(text, "\\s+", " ")), f"(.{{1,{width}}})(?: |$)", "$1\n"), F.lit("\n"))


def data_url(data: Column, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(data), "[\\r\\n]", ""))


def data_url_bytes(url: Column) -> Column:
    return F.unbase64(F.substring_index(url, "base64,", -1))
