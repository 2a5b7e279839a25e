"""License scans: Dice coefficient over word bigrams against licence templates. DataFrame expressions only."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import ascii_lower, columns

#: Published licence texts and common notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License '
        "for the specific language governing permissions and limitations under the License."),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",),
}
#: Words are runs of ASCII letters and digits and of anything beyond ASCII; A-Z counts as a-z.
NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DICE = 0.8


def bigrams_of(text: str) -> list[str]:
    """The distinct bigrams of a template; one word alone is its own."""
    words = re.findall(NORMAL, "".join(c.lower() if c.isascii() else c for c in text))
    return list(dict.fromkeys([f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] or words))


def _bigrams(unit: Column) -> Column:
    words = F.regexp_extract_all(ascii_lower(unit), F.lit(NORMAL), F.lit(0))

    def paired(w: Column) -> Column:
        return F.when(F.size(w) < 2, w).otherwise(F.array_distinct(F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))))

    return F.element_at(F.transform(F.array(words), paired), 1)


def scanned(docs: DataFrame, templates=None, dice: float = DICE) -> DataFrame:
    """documents -> (doc_id, license, dice, n_matches, matches), a row per row; no shuffle.

    Units are the lines of a text, its paragraphs (split at blank lines, where there are any) and the whole of it; the bigrams of a unit are a set. A
    unit of n bigrams can reach the coefficient d with a template of m only if m d / (2 - d) <= n <= m (2 - d) / d: only then are they
    compared. matches has unit:number:license:coefficient of each unit's best template (ties by name) in order; license and dice are of the best
    match (the first of equals), null without one. Null and empty texts match nothing; rows repeat as they come; no rows: no rows.
    """
    listed = [(name, bigrams_of(t)) for name, texts in sorted((templates or TEMPLATES).items()) for t in texts]
    few, many = dice / (2 - dice), (2 - dice) / dice
    least, most = min(len(b) for _, b in listed) * few, max(len(b) for _, b in listed) * many

    def best(kind: str):
        def of_unit(unit: Column, i: Column) -> Column:
            def compared(b: Column) -> Column:
                def one(name: str, template: list[str]) -> Column:
                    n, m = F.size(b), len(template)
                    value = F.round(2 * F.size(F.array_intersect(b, F.array(*map(F.lit, template)))) / (n + m), 6)
                    fits = (n >= m * few - 1e-9) & (n <= m * many + 1e-9)
                    return F.when(fits, F.struct(value.alias("dice"), F.lit(name).alias("license")))

                found = F.when((F.size(b) >= least - 1e-9) & (F.size(b) <= most + 1e-9), F.filter(F.array(*(one(*x) for x in listed)), lambda x: x["dice"] >= dice))
                found = F.array_sort(found, lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0))
                return F.struct(F.lit(kind).alias("unit"), i.alias("number"), F.get(found, F.lit(0)).alias("best"))

            return F.element_at(F.transform(F.array(_bigrams(unit)), compared), 1)

        return of_unit

    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    units = [("line", F.split(text, "\n", -1)), ("paragraph", F.when(text.rlike(r"\n[\x20\x09\x0D]*\n"), F.split(text, r"\n[\x20\x09\x0D]*\n\s*", -1)).otherwise(none)), ("text", F.when(text.contains("\n"), F.array(text)).otherwise(none))]
    found = reduce(lambda a, b: F.concat(a, b), (F.filter(F.transform(u, best(kind)), lambda x: x["best"].isNotNull()) for kind, u in units))
    rows = columns(docs, doc_id="doc_id", text="text").select("doc_id", found.alias("m"))
    top = F.array_max(F.transform("m", lambda x: x["best"]["dice"]))
    first = F.get(F.filter("m", lambda x: x["best"]["dice"] == F.col("top")), F.lit(0))
    shown = F.transform("m", lambda x: F.concat_ws(":", x["unit"], x["number"].cast("string"), x["best"]["license"], F.format_number(x["best"]["dice"], 6)))
    return rows.withColumn("top", top).select("doc_id", first["best"]["license"].alias("license"), F.col("top").alias("dice"), F.size("m").cast("long").alias("n_matches"), F.array_join(shown, ",").alias("matches"))
