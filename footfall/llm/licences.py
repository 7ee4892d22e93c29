"""Wordings of well-known licences: headers, short texts, identifiers, and the long texts' files."""

from __future__ import annotations

from importlib import resources

_GNU = ("This {what} is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU {name} General Public License as published by the Free Software Foundation; "
        "either version {version} of the License, or (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. ")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used "
          "to endorse or promote products derived from this software without specific prior "
          "written permission. ")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE.")

# Customary headers and whole short texts.
WORDINGS = {
    "agpl-3.0-header": _GNU.format(what="program", name="Affero", version="3"),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."),
    "bsd-2-clause-text": _BSD + _BSD_END,
    "bsd-3-clause-text": _BSD + _BSD_3 + _BSD_END,
    "bsl-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, "
        "and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so"),
    "gpl-2.0-header": _GNU.format(what="program", name="", version="2"),
    "gpl-3.0-header": _GNU.format(what="program", name="", version="3"),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
        "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "lgpl-2.1-header": _GNU.format(what="library", name="Lesser", version="2.1"),
    "lgpl-3.0-header": _GNU.format(what="library", name="Lesser", version="3"),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means."),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely"),
    "agpl-3.0-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "bsd-2-clause-notice": "Licensed under the BSD 2-Clause License.",
    "bsd-3-clause-notice": "Licensed under the BSD 3-Clause License.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "isc-notice": "Licensed under the ISC License.",
}
_IDENTIFIERS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense",
    "Zlib")
WORDINGS |= {f"{i.lower()}-identifier": f"SPDX-License-Identifier: {i}" for i in _IDENTIFIERS}
_FILES = {"apache-2.0": "Apache-2.0", "cc0-1.0": "CC0-1.0", "gfdl-1.3": "GFDL-1.3",
          "gpl-2.0": "GPL-2", "gpl-3.0": "GPL-3", "lgpl-2.1": "LGPL-2.1", "lgpl-3.0": "LGPL-3",
          "mpl-2.0": "MPL-2.0"}


def wordings() -> dict[str, str]:
    """The wordings above and the whole long texts, by name."""
    folder = resources.files("footfall.llm") / "licences"
    return WORDINGS | {f"{name}-text": (folder / f"{file}.txt").read_text(encoding="utf-8")
                       for name, file in _FILES.items()}
