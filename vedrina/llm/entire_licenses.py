"""Entire licence texts, from ``license_texts``, and file notices, in the forms in which they are found as whole documents."""

from __future__ import annotations

import re
from importlib.resources import files

from vedrina.llm.known_licenses import KNOWN

# The titles under which the short licences are published.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "Zero Clause BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License"],
    "ISC": ["The ISC License", "ISC License (ISC)"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng license"],
}
# Paragraphs of an entire text that are its title.
_TITLE_PARAGRAPHS = {"CC0-1.0": 2, "Unlicense": 0}
_END = re.compile(r"\n[ \t]*END OF TERMS AND CONDITIONS[ \t]*\n")
_EXHIBIT = re.compile(r"\nExhibit A - ")
_LIST_NUMBER = re.compile(r"(?m)^[ \t]*\d+[.)][ \t]+")
_ADDRESSES = (
    "write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA.",
    "write to the Free Software Foundation, Inc., 51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "see <https://www.gnu.org/licenses/>.",
)


def _layouts(text: str) -> list[str]:
    """As it is, with a line per paragraph, and in one line: lines that begin with a copyright differ."""
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
    return [text, "\n".join(paragraphs), " ".join(text.split())]


def _full(name: str, text: str) -> list[str]:
    """With and without its title, and with and without what follows the terms."""
    text = text.replace("\f", "").strip("\n") + "\n"
    untitled = text
    for _ in range(_TITLE_PARAGRAPHS.get(name, 1)):
        untitled = re.split(r"\n\s*\n", untitled, maxsplit=1)[1]
    found = []
    for form in dict.fromkeys([text, untitled]):
        found.append(form)
        if end := _END.search(form):
            found += [form[: end.end()], form[: end.start()]]
        if exhibit := _EXHIBIT.search(form):
            found.append(form[: exhibit.start()])
    found += [f"{title}\n\n{text}" for title in TITLES.get(name, [])]
    return [layout for form in found for layout in _layouts(form)]


def _gnu_notices() -> dict[str, list[str]]:
    """'This program is free software', for each licence, version, noun and ending."""
    licenses = {
        "GPL": ("GNU General Public License", {"2": "2.0", "3": "3.0"}),
        "LGPL": ("GNU Lesser General Public License", {"2.1": "2.1", "3": "3.0"}),
        "AGPL": ("GNU Affero General Public License", {"3": "3.0"}),
    }
    found: dict[str, list[str]] = {}
    for short, (title, versions) in licenses.items():
        for version, full in versions.items():
            for kind in ("only", "or-later"):
                for noun in ("program", "library", "software", "file"):
                    which = f"version {version} of the License" if kind == "only" else f"either version {version} of the License, or (at your option) any later version"
                    for only in ((which, f"{which} only") if kind == "only" else (which,)):
                        for head in (f"This {noun} is free software; you can", f"This {noun} is free software: you can"):
                            first = f"{head} redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation, {only}."
                            waste = (
                                f"This {noun} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
                                f" MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."
                            )
                            last = [f"You should have received a copy of the {title} along with this {noun}; if not, {where}" for where in _ADDRESSES]
                            last += [f"You should have received a copy of the {title} along with this {noun}."]
                            found.setdefault(f"{short}-{full}-{kind}", []).extend(
                                [first, f"{first}\n\n{waste}", *(f"{first}\n\n{waste}\n\n{end}" for end in last)]
                            )
    # Punctuation does not tell forms apart.
    return {name: list({re.sub(r"\W+", " ", text): text for text in texts}.values()) for name, texts in found.items()}


def entire() -> dict[str, list[str]]:
    """By SPDX name."""
    found: dict[str, list[str]] = {}
    for file in sorted(files("vedrina.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name = file.name.removesuffix(".txt")
        found[name] = _full(name, file.read_text(encoding="utf-8"))
    for name in ("0BSD", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Zlib"):
        texts = [text for text in KNOWN[name] if "AS IS" in text.upper() or "AS-IS" in text.upper()]
        plain = [*texts, *(_LIST_NUMBER.sub("", text) for text in texts)]
        found[name] = plain + [f"{title}\n\n{text}" for title in TITLES.get(name, []) for text in plain]
    for name, texts in _gnu_notices().items():
        found.setdefault(name, []).extend(texts)
    return found
