import sys

from lexgate.plans.job import main

sys.exit(main())
