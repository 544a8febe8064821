"""Where the files of public tokenizers lie; never copied into the repository."""

from __future__ import annotations

import os

#: Names the folder of the files, if they are not installed as a package.
FOLDER_SETTING = "SKYLEDGER_TOKENIZERS"


def piece_model(name: str = "piece_bpe_32k.model") -> str:
    """The path of a model file, on the driver and on every executor."""

    folder = os.environ.get(FOLDER_SETTING)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
