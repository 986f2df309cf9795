"""Notices by which licence families are recognised (fixed values: the usual
wording of short notices and opening sentences, in lower case, without
punctuation; ``#`` stands for a year or a name)."""

TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "this project is licensed under the terms of the apache license 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "spdx license identifier apache 2 0",
    ],
    "MIT": [
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "spdx license identifier mit",
    ],
    "BSD": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "use of this source code is governed by a bsd style license that can be found in the license file",
        "released under the bsd 3 clause license",
        "licensed under the simplified bsd 2 clause license",
        "spdx license identifier bsd 3 clause",
    ],
    "GPL-2.0": [
        "this work is licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "released under the gnu gpl version 2",
        "spdx license identifier gpl 2 0 only",
    ],
    "GPL-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "released under the gnu gpl version 3",
        "spdx license identifier gpl 3 0 or later",
    ],
    "LGPL": [
        "this library is licensed under the gnu lesser general public license",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "spdx license identifier lgpl 2 1 or later",
    ],
    "AGPL-3.0": [
        "this work is licensed under the gnu affero general public license version 3",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "spdx license identifier agpl 3 0 only",
    ],
    "MPL-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "licensed under the mozilla public license version 2 0",
        "spdx license identifier mpl 2 0",
    ],
    "ISC": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "licensed under the isc license",
        "spdx license identifier isc",
    ],
    "CC-BY": [
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        "available under the creative commons attribution license",
    ],
    "CC-BY-SA": [
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        "text is available under the creative commons attribution sharealike license",
    ],
    "CC-BY-NC": [
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "available under the creative commons attribution noncommercial license",
    ],
    "CC0": [
        "licensed under cc0 1 0 universal",
        "to the extent possible under law the author has waived all copyright and related rights to this work",
        "this is free and unencumbered software released into the public domain",
        "dedicated to the public domain",
    ],
    "Proprietary": [
        "copyright # all rights reserved",
        "this software is proprietary and confidential unauthorized copying of this file via any medium is strictly prohibited",
        "no part of this publication may be reproduced without the prior written permission of the publisher",
    ],
}
