"""``python -m trimatch match|ledger|split-types|breakdown ...``"""

from trimatch.plans.jobs import main

main()
