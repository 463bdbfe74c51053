import sys

from urbanlake.cli import main

sys.exit(main())
