"""Notices the licence classifier is trained on and compared with.

Fixed values: the usual short notices of each licence family, and sentences that use the
same words for something else.
"""

TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for full license information.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GNU GPL version 2.",
        "Licensed under the GPLv3.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Licensed under the LGPLv3.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Released under the AGPLv3.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "EPL": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License 3.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this "
        "work under Creative Commons Zero.",
    ],
    "Public-Domain": [
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Proprietary": [
        "Copyright Example Corporation. All rights reserved.",
        "This document is confidential and proprietary; no part may be reproduced without prior written "
        "permission of the copyright owner.",
    ],
}

OTHER: list[str] = [
    "Bring your driving license and a passport.",
    "The driver lost her license after the accident.",
    "A fishing license is required at the lake.",
    "The restaurant waited months for a liquor license.",
    "He took the number of the license plate.",
    "Poetic license lets the author move the river.",
    "The nurse renewed her license to practice.",
    "The washing machine comes with a two year warranty.",
    "The warranty does not cover water damage.",
    "Call us if the warranty card is missing.",
    "She asked permission to leave the room.",
    "You need permission from your parents.",
    "Without permission nobody enters the building.",
    "The lecture on copyright law starts at noon.",
    "Copyright has been debated for three centuries.",
    "The Apache helicopter landed near the village.",
    "Apache tribes lived in the south west.",
    "He studied physics at MIT in the sixties.",
    "An MIT professor won the prize.",
    "The eclipse was visible in the whole country.",
    "We watched the solar eclipse from the public garden.",
    "A gnu is a large antelope of the plains.",
    "The House of Commons voted on Tuesday.",
    "Creative writing is taught on Mondays.",
    "The general public was invited to the opening.",
    "The redistribution of land took ten years.",
    "Redistribution of wealth was the subject of the debate.",
    "The source of the river lies in the mountains.",
    "Attribution of the painting is uncertain.",
    "The minister waived the fee for students.",
    "Mozilla hired two engineers.",
    "The public domain name system is old.",
    "The proprietary blend of spices is sold in jars.",
    "All rights belong to the heirs, she said.",
]

#: Words that make a paragraph worth a look; every n-gram of the model holds one.
CUES: list[str] = [
    "license", "licensed", "licence", "licenced", "licenses", "spdx-license-identifier", "spdx", "mit",
    "apache", "apache-2.0", "gnu", "gpl", "gplv2", "gplv3", "gpl-2.0-only", "gpl-3.0-or-later", "lgpl",
    "lgplv3", "lgpl-2.1-or-later", "agpl", "agplv3", "agpl-3.0-only", "affero", "lesser", "bsd",
    "bsd-style", "bsd-2-clause", "3-clause", "redistribution", "redistribute", "mozilla", "mpl", "mpl-2.0",
    "eclipse", "epl-2.0", "isc", "cc", "by-sa", "by-nc", "by-nd", "cc-by-4.0", "cc0", "creative", "commons",
    "attribution", "attribution-sharealike", "attribution-noncommercial", "attribution-noderivatives",
    "sharealike", "noncommercial", "noderivatives", "unlicense", "unencumbered", "domain", "copyright",
    "reserved", "proprietary", "confidential", "permission", "warranty", "waived", "granted", "permitted",
]
