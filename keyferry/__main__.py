import sys

from keyferry.cli import main

sys.exit(main())
