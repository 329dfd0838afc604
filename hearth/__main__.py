"""``python -m hearth --sf-dir DIR [--out ROOT]``: the whole batch flow."""

from hearth.plans.workflow import main

main()
