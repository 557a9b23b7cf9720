"""License scans by template-markup matching.

A template is license wording with markup: ``[[ ... ]]`` is an optional
region, ``{{n}}`` a replaceable region of up to n words, ``a|b`` a choice
between two words.  Each template is compiled into an automaton over words; a
text is accepted where the mandatory words match exactly and in order.
Templates are few and fixed, so all automata travel with the task.

In a pass over the texts, the words are hashed in numpy; only texts that hold a
template's key word, the longest of its mandatory words, are given to its
automaton, and that only from words a match can begin with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import ALNUM, Words, hash_word, split_words, text_slices


@dataclass(frozen=True)
class Template:
    """``base`` templates give the contract's places; the others give more labels.

    ``whole`` templates are whole license texts or notices, from the first
    mandatory word to the last; the others are mentions.
    """

    label: str
    markup: str
    base: bool = False
    whole: bool = False


#: Labels and mandatory wording.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "[[the]] mit license [[mit]] [[copyright {{12}}]] permission is hereby granted free of charge to any person "
                    "obtaining a copy of this software and associated documentation files"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
                    "software and associated documentation files [[the software]] to deal in the software without restriction"),
    Template("apache-2", "licensed under the apache license [[version]] 2 [[0]] [[the license]] you may not use this file "
                         "except in compliance with the license"),
    Template("cc-by-nc", "creative commons attribution non|noncommercial [[commercial]] [[{{1}} 0]] [[international|unported]] "
                         "[[public]] license"),
    Template("gpl-3", "gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    Template("gpl-2", "gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("mpl-2", "[[subject to the terms of the]] mozilla public license [[v|version]] 2 [[0]]"),
    Template("all-rights-reserved", "copyright {{12}} all rights reserved"),
    # whole texts and notices
    Template("mit", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all
        copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall {{8}} be
        liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from
        out of or in connection with the software or the use or other dealings in the software""", whole=True),
    Template("isc", """
        permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies
        the software is provided as is and {{6}} disclaims|disclaim all warranties with regard to this software including
        all implied warranties of merchantability and fitness in no event shall {{6}} be liable for any special direct
        indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in
        an action of contract negligence or other tortious action arising out of or in connection with the use or
        performance of this software""", whole=True),
    Template("bsd-2", """
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met
        [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer
        [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the
        following disclaimer in the documentation and or other materials provided with the distribution
        this software is provided by {{8}} as is and any express or implied warranties including but not limited to the
        implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{8}}
        be liable for any direct indirect incidental special exemplary or consequential damages including but not limited
        to procurement of substitute goods or services loss of use data or profits or business interruption however caused
        and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
        arising in any way out of the use of this software even if advised of the possibility of such damage""", whole=True),
    Template("bsd-3", """
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met
        [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer
        [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the
        following disclaimer in the documentation and or other materials provided with the distribution
        [[3]] neither the name of {{12}} nor the names of {{4}} contributors may be used to endorse or promote products
        derived from this software without specific prior written permission
        this software is provided by {{8}} as is and any express or implied warranties including but not limited to the
        implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{8}}
        be liable for any direct indirect incidental special exemplary or consequential damages including but not limited
        to procurement of substitute goods or services loss of use data or profits or business interruption however caused
        and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
        arising in any way out of the use of this software even if advised of the possibility of such damage""", whole=True),
    Template("zlib", """
        this software is provided as is without any express or implied warranty in no event will {{4}} be held liable for
        any damages arising from the use of this software
        permission is granted to anyone to use this software for any purpose including commercial applications and to alter
        it and redistribute it freely subject to the following restrictions
        [[1]] the origin of this software must not be misrepresented you must not claim that you wrote the original
        software if you use this software in a product an acknowledgment|acknowledgement in the product documentation would
        be appreciated but is not required
        [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the original
        software [[3]] this notice may not be removed or altered from any source distribution""", whole=True),
    Template("apache-2", """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
        license you may obtain a copy of the license at http|https www apache org licenses license 2 0
        unless required by applicable law or agreed to in writing software distributed under the license is distributed on
        an as is basis without warranties or conditions of any kind either express or implied see the license for the
        specific language governing permissions and limitations under the license""", whole=True),
    Template("mpl-2", """
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at http|https [[www]] mozilla org mpl 2 0""", whole=True),
    Template("gpl-2", """
        program|software|file is free software you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 2 of the license or at your option any
        later version [[this {{1}} is distributed in the hope that it will be useful but without any warranty without even
        the implied warranty of merchantability or fitness for a particular purpose]]""", whole=True),
    Template("gpl-3", """
        program|software|file is free software you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 3 of the license or at your option any
        later version [[this {{1}} is distributed in the hope that it will be useful but without any warranty without even
        the implied warranty of merchantability or fitness for a particular purpose]]""", whole=True),
    Template("lgpl-2.1", """
        library|program|software is free software you can redistribute it and or modify it under the terms of the gnu
        lesser general public license as published by the free software foundation either version 2 1 of the license or at
        your option any later version""", whole=True),
    Template("lgpl-3", """
        library|program|software is free software you can redistribute it and or modify it under the terms of the gnu
        lesser general public license as published by the free software foundation either version 3 of the license or at
        your option any later version""", whole=True),
    Template("unlicense", """
        this is free and unencumbered software released into the public domain
        anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as
        a compiled binary for any purpose commercial or non commercial and by any means
        in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain we make this dedication for the benefit of the public at
        large and to the detriment of our heirs and successors we intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this software under copyright law""", whole=True),
)


class WordAutomaton:
    """Automaton of one template; its states are positions between words."""

    def __init__(self, template: Template):
        self.template = template
        self.moves: list[dict[str, list[int]]] = [{}]
        self.any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        mandatory: list[str] = []
        state, opened = 0, []
        for token in template.markup.replace("[[", " [[ ").replace("]]", " ]] ").split():
            if token == "[[":
                opened.append(state)
            elif token == "]]":
                self.free[opened.pop()].append(state)
            elif token.startswith("{{"):
                for _ in range(int(token[2:-2])):
                    new = self._new()
                    self.any[state].append(new)
                    skip = state
                    state = new
                    self.free[skip].append(state)
            else:
                new = self._new()
                for word in token.split("|"):
                    self.moves[state].setdefault(word, []).append(new)
                if not opened and "|" not in token:
                    mandatory.append(token)
                state = new
        self.final = state
        self.key = max(mandatory, key=len)
        self.mandatory = len(mandatory)
        start = self._closure({0})
        assert not any(self.any[s] for s in start), "a template begins with a word"
        self.begins = {w for s in start for w in self.moves[s]}

    def _new(self) -> int:
        self.moves.append({})
        self.any.append([])
        self.free.append([])
        return len(self.moves) - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo, states = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[str], at: int) -> int | None:
        """End of the shortest accepted run of words that begins at ``at``."""
        states = self._closure({0})
        for i in range(at, len(words)):
            word = words[i]
            step = set()
            for s in states:
                step.update(self.moves[s].get(word, ()))
                step.update(self.any[s])
            if not step:
                return None
            states = self._closure(step)
            if self.final in states:
                return i + 1
        return None


class Scanner:
    """All templates, with hash sets of key words and first words."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES):
        self.automata = [WordAutomaton(t) for t in templates]
        self.keys = np.array([hash_word(a.key) for a in self.automata], dtype=np.uint64)
        self.begins = [np.array([hash_word(w) for w in sorted(a.begins)], dtype=np.uint64) for a in self.automata]

    def scan(self, words: Words) -> dict[int, list[tuple[int, int, int]]]:
        """Per text with a match: (first word, end word, template), words counted within the text."""
        hashes = words.hashes()
        text_of = words.text_of()
        found: dict[int, list[tuple[int, int, int]]] = {}
        cache: dict[int, list[str]] = {}
        key_at = np.flatnonzero(np.isin(hashes, self.keys))
        for k, automaton in enumerate(self.automata):
            own = key_at[hashes[key_at] == self.keys[k]]
            for d in np.unique(text_of[own]).tolist():
                a, b = int(words.first[d]), int(words.first[d + 1])
                starts = np.flatnonzero(np.isin(hashes[a:b], self.begins[k]))
                if len(starts) and d not in cache:
                    cache[d] = [words.word(w).decode() for w in range(a, b)]
                for at in starts.tolist():
                    end = automaton.match(cache[d], at)
                    if end is not None:
                        found.setdefault(d, []).append((at, end, k))
        return found


SCHEMA = "doc_id {}, n_words long, matches array<struct<first:int,end:int,label:string,base:boolean,whole:boolean,mandatory:int>>"


def covered_words(matches: Column) -> Column:
    """Number of words that matches lie over, those of overlapping ones once; ``matches`` are sorted by their first word."""
    return F.aggregate(
        matches, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, m: F.struct((acc["n"] + F.greatest(m["end"] - F.greatest(m["first"], acc["end"]), F.lit(0))).alias("n"),
                                F.greatest(acc["end"], m["end"]).alias("end")),
        lambda acc: acc["n"])


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, matches (word positions, end exclusive).

    Words are maximal runs of letters a-z (after lower-casing A-Z), digits and
    non-ASCII characters; matches may overlap and are given for every place, by
    first word.  ``whole`` ones are whole license texts or notices.

    Cases: a null or empty text has no words and no matches; rows with a null
    or repeated doc_id are scanned like others; an empty table gives no rows;
    other columns are ignored.
    """
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("label", pa.string()),
                               ("base", pa.bool_()), ("whole", pa.bool_()), ("mandatory", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                words = split_words(data, bounds, ALNUM)
                found = scanner.scan(words)
                matches = [[{"first": a, "end": e, "label": scanner.automata[k].template.label,
                             "base": scanner.automata[k].template.base, "whole": scanner.automata[k].template.whole, "mandatory": scanner.automata[k].mandatory}
                            for a, e, k in sorted(found.get(d, ()))] for d in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts().astype(np.int64)), pa.array(matches, kind)],
                    ["doc_id", "n_words", "matches"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))
